"""Work that grew faster than the input: mixing, the n-gram join, the graph search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import catalog, hnsw_dedup, mixing, ngram_join


@pytest.fixture()
def no_broadcast(spark):
    catalog.ship(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def text_exchanges(df, column: str) -> list:
    """Exchanges of the plan that move the column, with the nodes below each."""

    def below(plan):
        kids = plan.children()
        for i in range(kids.size()):
            yield kids.apply(i)
            yield from below(kids.apply(i))

    top = df._jdf.queryExecution().executedPlan().initialPlan()
    return [[x.nodeName() for x in below(p)] for p in below(top) if p.nodeName() == "Exchange" and f"{column}#" in p.output().toString()]


def test_mixing_shuffles_a_text_once(no_broadcast):
    rows = [(i % 40 if i % 9 else None, " ".join(f"w{i}x{j}" for j in range(20 + i % 3)), "ab"[i % 2]) for i in range(300)]
    docs = no_broadcast.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_documents(docs)
    assert len(text_exchanges(mixed, "text")) == 1
    # rows that share id, source and size have a place each, and keep their own words
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in mixed.collect())
    assert got == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in mixing.mix_documents(docs).collect())
    taken = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["taken"]) for r in mixing.taken_counts(docs).collect() if r["taken"])
    assert sorted((n, i, len(t.split())) for n, i, t in got) == taken
    owners = [{w.split("x")[0] for w in t.split()} for _, _, t in got]
    assert all(len(o) == 1 for o in owners) and len(set.union(*owners)) == len(owners)


def test_texts_that_are_not_wanted_are_not_shuffled(no_broadcast):
    rows = [(i, f"text {i}") for i in range(400)] + [(3, "another"), (3, "text 3"), (None, "none")]
    docs = no_broadcast.createDataFrame(rows, "doc_id long, text string")
    wanted = no_broadcast.createDataFrame([(3,), (7,), (7,), (399,)], "node long")
    got = ngram_join._texts_of(docs, wanted)
    assert all("BroadcastHashJoin" in nodes for nodes in text_exchanges(got, "data"))
    assert sorted((r["node"], bytes(r["data"]).decode()) for r in got.collect()) == [(3, "another"), (3, "text 3"), (7, "text 7"), (399, "text 399")]
    ids = wanted.select(F.col("node").alias("doc_id")).distinct()
    assert ngram_join._marked(ngram_join._texts(docs), ids).count() < 20


def test_graph_searches_begin_at_the_node_itself(monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(60, 16))
    unit = centre[rng.integers(0, 60, 900)] + 0.08 * rng.normal(size=(900, 16))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    graph = hnsw_dedup.Graph(unit)
    want = set(zip(*[x.tolist() for x in np.nonzero(unit @ unit.T >= 0.93)], strict=True))
    monkeypatch.setattr(hnsw_dedup.Graph, "_descend", lambda *_: pytest.fail("a node of the graph searched from the top"))
    a, b = hnsw_dedup.audited_links(graph, unit, np.arange(900), 0.93)
    assert len(a) == len(set(zip(a.tolist(), b.tolist(), strict=True))) and set(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_a_label_of_some_thousands_is_one_graph(spark):
    def pieces(n):
        nodes = spark.range(n).select(F.lit(1).alias("label"), F.repeat(F.lit("x"), 512).cast("binary").alias("vec"), F.col("id").cast(hnsw_dedup.NODE).alias("node"))
        return {tuple(r) for r in hnsw_dedup._dealt(nodes).select("dim", "shards", "blocks").distinct().collect()}

    assert pieces(6000) == {(512, 1, 1)}
    assert pieces(20000) == {(512, 2, 2)}
