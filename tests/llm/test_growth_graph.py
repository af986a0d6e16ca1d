"""Graph searches of dense groups."""

import numpy as np

from shopfloor.llm import hnsw_dedup


def _unit(parts):
    rows = np.concatenate(parts)
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def _true(q, unit):
    a, b = np.nonzero(q @ unit.T >= 0.93)
    return set(zip(a.tolist(), b.tolist(), strict=True))


def test_a_dense_group_is_searched_together():
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(1, 64))
    unit = _unit([centre + 0.13 * rng.normal(size=(900, 64)), rng.normal(size=(1500, 64))])
    graph = hnsw_dedup.Graph(unit)
    scored, product = [], hnsw_dedup._distinct
    hnsw_dedup._distinct = lambda key: scored.append(len(key)) or product(key)
    try:
        a, b = hnsw_dedup.audited_links(graph, unit, np.arange(2400), 0.93)
    finally:
        hnsw_dedup._distinct = product
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == _true(unit, unit) and len(a) == len(_true(unit, unit))
    # neighbours to be looked at grow as the nodes, not as the group's links times the links of a node
    assert sum(scored) < 2400 * 2500 < 900 * 900 * hnsw_dedup.LINKS


def test_queries_of_another_shard_find_dense_groups_and_chains():
    rng = np.random.default_rng(6)
    centre, way = rng.normal(size=(1, 64)), np.cumsum(0.22 * rng.normal(size=(120, 64)), axis=0) + rng.normal(size=(1, 64))
    parts = [centre + 0.13 * rng.normal(size=(400, 64)), way, rng.normal(size=(600, 64)), centre * 2 + 0.5 * rng.normal(size=(80, 64))]
    unit = _unit(parts)
    at = rng.permutation(len(unit))
    here, there = unit[at[:700]], unit[at[700:]]
    a, b = hnsw_dedup.audited_links(hnsw_dedup.Graph(here), there, np.full(len(there), -1), 0.93)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == _true(there, here)
    assert len(a) == len(set(zip(a.tolist(), b.tolist(), strict=True)))


def test_groups_are_the_components():
    a, b = np.array([5, 4, 4, 3, 1, 1, 0]), np.array([9, 9, 7, 7, 2, 3, 3])
    assert hnsw_dedup._groups(7, 10, a, b).tolist() == [0, 0, 2, 3, 3, 3, 6]
