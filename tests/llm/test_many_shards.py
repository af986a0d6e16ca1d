"""Paths that small tables do not reach: several blocks, cells and shards, unequal lengths, samples of larger tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import grams, unite

from shopfloor.llm import catalog, common, mixing, ngram_join, permutation_ann


def near_copies():
    """Families of near copies that share n-grams with one another, and rows that repeat an id."""
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(8):
        base = list(rng.choice(words, 60))
        for _ in range(24):
            text = list(base)
            for k in rng.integers(0, 60, rng.integers(0, 3)):
                text[k] = str(rng.choice(words))
            rows.append((len(rows), " ".join(text)))
        rows.append((len(rows), " ".join(base[:30] + list(rng.choice(words, 30)))))
    rows += [(5, rows[40][1]), (5, rows[5][1]), (5, rows[5][1]), (7, None)]
    return rows


def test_ngram_join_over_chunks_and_cells(spark, monkeypatch):
    catalog.ship(spark)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    monkeypatch.setattr(ngram_join, "CELL_ROWS", 4)
    rows = near_copies()
    got = ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    sets = [grams(t, 4) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] == rows[j][0] or ((o := len(sets[i] & sets[j])) and 100 * o >= 85 * (len(sets[i]) + len(sets[j]) - o))]
    root = unite(len(rows), pairs)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = min(i, least.get(r, i))
    # rows of one id that hold different sets count as one document
    want = sorted((i, len(s), least[r]) for (i, _), s, r in zip(rows, sets, root, strict=True) if s)
    assert sorted(tuple(r) for r in got if r["n_shingles"]) == want


@pytest.mark.parametrize("sigma", [0.0, 0.5])
def test_recall_with_unequal_lengths_over_shards(spark, monkeypatch, sigma):
    catalog.ship(spark)
    monkeypatch.setattr(permutation_ann, "SHARD_ROWS", 1000)
    monkeypatch.setattr(permutation_ann, "QUERY_ROWS", 64)
    rng = np.random.default_rng(2)
    v = rng.standard_normal((3000, 32)) * np.exp(sigma * rng.standard_normal(3000))[:, None]
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    found = {}
    for r in permutation_ann.search(table, F.col("vec_id") % 20 == 0, least=64).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    score = v[::20] @ v.T
    score[np.arange(150), np.arange(0, 3000, 20)] = -np.inf
    true = np.argsort(-score, axis=1)[:, :20]
    assert np.mean([len(found[20 * k] & set(t.tolist())) / 20 for k, t in enumerate(true)]) >= 0.9


def test_a_sample_sees_a_bounded_number_of_rows(spark):
    docs = spark.range(200_000).withColumnRenamed("id", "doc_id")
    assert 1500 < docs.where(common.hash_share(1000, 200_000)).count() < 2500
    few = docs.limit(100).unionByName(spark.createDataFrame([(None,)], "doc_id long"))
    assert few.where(common.hash_share(1000, 101)).count() == 101


def test_slots_are_dealt_to_all_tasks(spark):
    catalog.ship(spark)
    plan = mixing.Plan([("a", 400_000), ("b", 300_000), (None, 100_000)], block_words=4, shard_slots=1000)
    slots = mixing.drawn_slots(spark, plan)
    per_task = [r["count"] for r in slots.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == plan.total and len(per_task) > 1 and max(per_task) < 0.5 * plan.total
