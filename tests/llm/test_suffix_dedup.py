"""Repeated passages against brute force over all windows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shopfloor.llm import catalog, suffix_dedup

SF = "/root/testdata/sf0.001"
LAST = 2**63 - 1


def stretches(starts, width):
    out = []
    for s in sorted(starts):
        if out and s <= out[-1][1]:
            out[-1][1] = s + width
        else:
            out.append([s, s + width])
    return ",".join(f"{a}:{b}" for a, b in out)


def brute(rows, width):
    docs = [(LAST if i is None else i, i, (t or "").encode().lower().split()) for i, t in rows]
    held = defaultdict(set)
    for r, (_, _, w) in enumerate(docs):
        for s in range(len(w) - width + 1):
            held[tuple(w[s : s + width])].add(r)
    out = []
    for order, i, w in docs:
        among = {s: held[tuple(w[s : s + width])] for s in range(len(w) - width + 1)}
        again = [s for s, rs in among.items() if len(rs) > 1]
        later = [s for s in again if min(docs[r][0] for r in among[s]) < order]
        if again:
            out.append((i, len(w), stretches(again, width), stretches(later, width)))
    return sorted(out, key=repr)


def found(df):
    return sorted([(r.doc_id, r.n_words, r.spans, r.later_spans) for r in df.collect()], key=repr)


@pytest.fixture(scope="module")
def shipped(spark):
    catalog.ship(spark)
    return spark


def test_documents(shipped):
    docs = shipped.read.parquet(f"{SF}/documents.parquet")
    got = catalog.queries()["op8_suffix_dedup"](shipped, SF)
    assert found(got) == brute([(r.doc_id, r.text) for r in docs.collect()], suffix_dedup.PASSAGE)
    assert all(r.n_repeated == sum(int(b) - int(a) for a, b in (s.split(":") for s in r.spans.split(","))) for r in got.collect())


@pytest.mark.parametrize("passage,seed,letters", [(6, 2, "abc"), (5, 5, "ab"), (4, 1, "abcdefgh")])
def test_few_distinct_words(shipped, passage, seed, letters):
    rng = random.Random(passage)
    rows = [(rng.choice([None, *range(20)]), " ".join(rng.choice(letters) for _ in range(rng.randrange(0, 60)))) for _ in range(60)]
    rows += rows[:5] + [(None, rows[9][1]), (99, rows[9][1])]
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    assert found(suffix_dedup.repeats(docs, passage, seed)) == brute(rows, passage)


def test_odd_rows(shipped):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "again " * 3000), (6, passage), (6, passage), (None, f"x y {passage} z"),
        (None, None), (7, f"Ünd é  {passage.upper()} \x00 end"), (8, " ".join(f"q{i}" for i in range(100000)) + " " + passage), (9, " ".join(f"w{i}" for i in range(49))),
    ]
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumn("same", F.lit("clash")).withColumn("window", F.lit(None).cast("int")).withColumn("n_chars", F.length("text"))
    assert found(suffix_dedup.repeats(docs)) == brute(rows, 50)
    kept = {(r.doc_id, r.text) for r in suffix_dedup.drop_later(docs).collect()}
    assert {(6, passage), (None, "x y z"), (1, None), (5, "again " * 3000)} <= kept
    assert len([1 for i, _ in kept if i == 8]) == 1 and all(passage not in t for i, t in kept if i == 8)
    assert suffix_dedup.drop_later(docs).columns == docs.columns


def test_cut_keeps_the_rest():
    assert suffix_dedup.cut("a  b\tc d\n", "1:3") == "a  d\n"
    assert suffix_dedup.cut("é b", "0:2") == ""


def test_seed_longer_than_passage(shipped):
    with pytest.raises(ValueError):
        suffix_dedup.repeats(shipped.createDataFrame([(1, "a")], "doc_id long, text string"), 5, 6)
