"""Operators 11 to 13 against brute force, exact round trips and plain numpy."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import catalog, fill_middle, substring_dedup, whitening
from shopfloor.llm.fm_index import FMIndex

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def shipped(spark):
    catalog.ship(spark)
    return spark


def sha(data):
    return hashlib.sha256(data).hexdigest()


# ── 11 ───────────────────────────────────────────────────────────────────────


def repeats(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    held = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if held[tuple(w[s : s + window])] > 1:
                gone[s : s + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return sorted(out, key=repr)


def removed(df):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()], key=repr)


def longest_twice(pieces, weights):
    held = Counter()
    for p, w in zip(pieces, weights, strict=True):
        for i in range(len(p)):
            for j in range(i + 1, len(p) + 1):
                held[tuple(p[i:j])] += w
    return [[max((j - i for j in range(i + 1, len(p) + 1) if held[tuple(p[i:j])] > 1), default=0) for i in range(len(p))] for p in pieces]


@pytest.mark.parametrize("seed", range(60))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    letters = rng.randrange(1, 5)
    pieces = [[rng.randrange(1, letters + 1) for _ in range(rng.randrange(1, 14))] for _ in range(rng.randrange(1, 12))]
    weights, least = [rng.randrange(1, 3) for _ in pieces], rng.randrange(1, 6)
    sizes = np.array([len(p) + 1 for p in pieces])
    symbols = np.array([x for p in pieces for x in [*p, 0]])
    end = np.cumsum(sizes) - 1
    index = FMIndex(symbols, np.repeat(weights, sizes), int(sizes.max()))
    got = index.statistics(symbols, end - sizes + 1, end, least)
    for want, e in zip(longest_twice(pieces, weights), end, strict=True):
        found = got[e - len(want) : e].tolist()
        assert [f if f >= least else 0 for f in found] == [w if w >= least else 0 for w in want]


def test_backward_search_counts():
    rng = np.random.default_rng(1)
    symbols = np.append(rng.integers(1, 4, 400), 0)
    index = FMIndex(symbols, np.ones(401, int), 401)
    for size in (1, 2, 5):
        for i in range(0, 300, 7):
            low, high = np.array([0]), np.array([401])
            for c in symbols[i : i + size][::-1]:
                low, high = index.extend(np.array([c]), low, high)
            assert high[0] - low[0] == sum((symbols[j : j + size] == symbols[i : i + size]).all() for j in range(401 - size))


def test_substrings_of_documents(shipped):
    rows = [(r.doc_id, r.text) for r in shipped.read.parquet(f"{SF}/documents.parquet").collect()]
    assert removed(catalog.queries()["op11_substring_dedup"](shipped, SF)) == repeats(rows, 35)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("window,seed,letters", [(6, 2, "abc"), (5, 5, "ab"), (4, 1, "abcdefgh")])
def test_few_distinct_words(shipped, monkeypatch, window, seed, letters, hot):
    if hot:  # many shards, seeds split into windows, salted joins
        monkeypatch.setattr(substring_dedup, "HOT", 3)
        monkeypatch.setattr(substring_dedup, "SALTED", 5)
        monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 50)
    rng = random.Random(window)
    rows = [(rng.choice([None, *range(20)]), " ".join(rng.choice(letters) for _ in range(rng.randrange(0, 60)))) for _ in range(60)]
    rows += rows[:5] + [(None, rows[9][1]), (99, rows[9][1])]
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    assert removed(substring_dedup.remove_repeats(docs, window, seed)) == repeats(rows, window)


def test_substrings_of_odd_rows(shipped):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "again " * 3000), (6, passage), (6, passage), (None, f"x y {passage} z"),
        (None, None), (7, f"Ünd é  {passage} \x00 end"), (7, passage.upper()), (8, " ".join(f"q{i}" for i in range(100000)) + "\n" + passage),
        (9, " ".join(f"w{i}" for i in range(34))), (10, " ".join(f"w{i}" for i in range(1, 36)) + " other"), (11, "z " * 36 + "end"),
    ]
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    odd = docs.withColumn("same", F.lit("clash")).withColumn("seed", F.lit(None).cast("int")).withColumn("id", F.lit(1)).withColumn("data", F.lit(2))
    got = substring_dedup.remove_repeats(odd)
    assert removed(got) == repeats(rows, 35)
    kept = {(r.doc_id, r.spans, r.kept) for r in got.collect()}
    assert {(None, "2:42", "x y z"), (6, "0:40", ""), (1, "", ""), (10, "0:35", "other"), (11, "0:36", "end")} <= kept
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(docs, 5, 6)


# ── 12 ───────────────────────────────────────────────────────────────────────

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fill(i, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    n = len(tokens)
    digest = sha(f"42:{'' if i is None else i}".encode())
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return i, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [None, "", " ", "\t\n ", "a", " a", "a ", "é\x00 日本 𝔘", "<P> x", "a <M> b", "<S>", "<", "< P> <P", "P>S><", "\x1c \x85 \xa0x", "word " * 50000, "<" * 40, "x<P y"]


def test_fill_of_odd_rows(shipped):
    rows = [(None if i % 9 == 8 else i, ODD[i % len(ODD)]) for i in range(30 * len(ODD))] + [(3, "twice in it"), (3, "twice in it")]
    docs = shipped.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("output", F.lit(None).cast("int"))
    found = fill_middle.restore(fill_middle.transform(docs)).collect()
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found], key=repr) == sorted([plain_fill(*r) for r in rows], key=repr)
    assert Counter((r.doc_id, r.restored) for r in found) == Counter((i, t or "") for i, t in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert fill_middle.transform(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fill_middle.transform(docs, keep=["doc_id", "n"])
    with pytest.raises(ValueError):
        fill_middle.transform(docs, sentinels=("<P>", "<P>", "<M>"))


def test_fill_of_documents_matches_sql(shipped):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(catalog.oracle_sql()["op12_fill_middle"]).fetchall())
    got = catalog.queries()["op12_fill_middle"](shipped, SF)
    assert sorted(tuple(r) for r in got.collect()) == want
    texts = {r.doc_id: sha((r.text or "").encode()) for r in shipped.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r.restored_sha256 == texts[r.doc_id] for r in got.collect())


@pytest.mark.parametrize("seed", range(30))
def test_exchange_in_place(seed):
    rng = random.Random(seed)
    data = rng.randbytes(rng.randrange(0, 50))
    a, b, c = sorted(rng.randrange(len(data) + 1) for _ in range(3))
    buffer = bytearray(data)
    fill_middle.exchange(buffer, a, b, c)
    assert bytes(buffer) == data[:a] + data[b:c] + data[a:b] + data[c:]
    fill_middle.exchange(buffer, a, a + c - b, c)
    assert bytes(buffer) == data


# ── 13 ───────────────────────────────────────────────────────────────────────


@pytest.mark.parametrize("spread", [0, 1, 300, 2**40, 2**62])
def test_cross_products_are_exact(spread):
    rng = np.random.default_rng(spread % 97)
    x = rng.integers(-spread - 1, spread + 1, (150, 5))
    sums, products = whitening.cross_products(x)
    wide = [[int(v) for v in row] for row in x]
    assert sums.tolist() == [sum(r[j] for r in wide) for j in range(5)]
    assert products.tolist() == [[sum(r[i] * r[j] for r in wide) for j in range(5)] for i in range(5)]


def plain_whitening(vectors):
    """x of every vector, and from their distinct ones n, S, mean, falling eigenvalues, eigenvectors and trace."""
    x = np.floor(256 * np.array(vectors, np.float64)).astype(np.int64)
    listed = np.unique(x, axis=0)
    n, s = len(listed), listed.sum(axis=0)
    mean = np.array([float(Fraction(int(v), n)) for v in s])
    centred = listed - mean
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    return x, n, s, mean, e[::-1], q[:, ::-1], np.trace(v)


def test_whitening_of_embeddings(shipped):
    rows = shipped.read.parquet(f"{SF}/embeddings.parquet").collect()
    x, n, s, mean, e, q, trace = plain_whitening([r.embedding for r in rows])
    place = {r.vec_id: i for i, r in enumerate(rows)}
    found = catalog.queries()["op13_whitening"](shipped, SF).collect()
    assert len(found) == 4 * len(rows) and {r.component for r in found} == {1, 2, 3, 4}
    sign = {}
    for r in found:
        i, k = place[r.vec_id], r.component - 1
        assert r.n == n and r.deviation == sum((n * int(v) - int(t)) ** 2 for v, t in zip(x[i], s, strict=True)) == int(r.deviation_wide)
        want = (x[i] - mean) @ q[:, k] / np.sqrt(e[k])
        side = sign.setdefault(k, np.sign(want * r.whitened) or 1.0)
        assert abs(r.whitened - side * want) < 1e-6
        assert abs(r.explained - e[k] / trace) <= 1e-4 * e[k] / trace
        assert r.identity_error <= 1e-4
    assert len({r.identity_error for r in found}) == 1


def test_whitening_of_odd_rows(shipped):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    good = [rng.normal(size=3).tolist() for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(good)] + [(0, good[1]), (None, good[2]), (90, None), (91, [1.0, None, 2.0]), (92, [nan, 0.0, 0.0]), (93, [0.0, inf, 0.0]), (94, []), (95, [1.0, 2.0]), (96, [-0.0, 0.0, 0.0])]
    table = shipped.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("clash")).withColumn("component", F.lit(7))
    used = [(i, v) for i, v in rows if v and len(v) == 3 and all(c is not None and np.isfinite(c) for c in v)]
    x, n, s, *_ = plain_whitening([v for _, v in used])
    found = whitening.whiten(table).collect()
    assert Counter((r.vec_id, r.component, r.n, r.deviation) for r in found) == Counter(
        (i, k, n, sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s, strict=True))) for (i, _), row in zip(used, x, strict=True) for k in (1, 2, 3)
    )
    assert max(r.identity_error for r in found) < 1e-4 and abs(sum({r.component: r.explained for r in found}.values()) - 1) < 1e-9
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id between 90 and 94")).collect() == []
    assert whitening.whiten(table.limit(0)).columns == whitening.whiten(table).columns


def test_whitening_without_variance(shipped):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    same = whitening.whiten(shipped.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert [(r.n, r.deviation, r.whitened, r.identity_error) for r in same] == [(1, 0, None, None)] * 4
    line = whitening.whiten(shipped.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")).collect()
    assert sorted((r.component, r.whitened is None) for r in line) == [(1, False), (1, False), (2, True), (2, True)]
    far = whitening.whiten(shipped.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in far} == {None} and {r.component for r in far} == {1, 2}
