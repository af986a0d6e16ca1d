"""Operators of ``shopfloor.llm`` against brute force, round trips and held-out rows."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopfloor.llm import catalog, common, hnsw_dedup, language_id, lattice_lm, mixing, ngram_join, permutation_ann, secret_scan, sentencepiece_codec, toxicity
from shopfloor.llm.common import connected_components

SF = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
ODD = [
    (1, "Hello  World ", "en", "a"), (1, "Hello  World ", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, " \t\n", None, "b"),
    (5, "▁x a▁b \x00 日本語 𝔘", "en", "b"), (6, "word " * 30000, "en", None), (None, "no id here at all", "en", "a"),
    (7, "password = \"abcDEF123456xyz\"", "de", "Z"), (8, "12 345 !!", "fr", "é"),
]


@pytest.fixture(scope="module")
def odd(spark):
    catalog.ship(spark)
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    return docs.withColumn("n_chars", F.length("text").cast("long")).withColumn("size", F.lit("clash")).withColumn("node", F.lit(None).cast("string"))


@pytest.fixture(scope="module")
def docs(spark):
    catalog.ship(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return (text or "").encode().lower().split()


def unite(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, name, tmp_path):
    for t in ("documents", "embeddings", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


def test_encoding_equals_the_library(docs, odd):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=catalog.vocabulary_path())
    for df in (docs, odd.drop("size")):
        texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
        got = sentencepiece_codec.encode_documents(df, catalog.vocabulary_path(), with_ids=True).collect()
        assert len(got) == df.count()
        for r in got:
            ids = sp.encode(texts[r["doc_id"]])
            assert (r["n_tokens"], r["ids"], r["decoded"]) == (len(ids), ids, sp.decode(ids))
            assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_agendas_agree():
    codec = sentencepiece_codec.codec(sentencepiece_codec.read_model(catalog.vocabulary_path()))
    for text in ("▁internationalisation", "▁" * 37 + "a", "aaaaaaa", "▁ééé"):
        assert codec.merge_short(text) == codec.merge(list(text))
    long = "x" * 5000
    assert codec.encode_unit(long) == codec.lib.encode(long)


def grams(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_ngram_join_equals_brute_force(docs, odd, n, percent):
    for df in (docs, odd.select("doc_id", "text").where("doc_id is not null")):
        rows = sorted({(r["doc_id"], r["text"]) for r in df.collect()}, key=lambda r: r[0])
        sets = [grams(t, n) for _, t in rows]
        pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (o := len(sets[i] & sets[j])) and 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o)]
        root = unite(len(rows), pairs)
        want = {(rows[i][0], len(sets[i]), rows[root[i]][0]) for i in range(len(rows))}
        assert {tuple(r) for r in ngram_join.classes(df, n, percent).collect()} == want


def test_trie_join_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        base = np.unique(rng.integers(0, 2**60, rng.integers(3, 80)).astype(np.uint64))
        sets = [np.unique(np.r_[base[rng.random(len(base)) > rng.choice([0, 0.03, 0.1, 0.4])], rng.integers(0, 2**60, 3).astype(np.uint64)]) for _ in range(20)]
        a, b = ngram_join.trie_join(sets, np.sort(base[::3]))
        want = {(i, j) for j in range(20) for i in range(j) if 100 * (o := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (len(sets[i]) + len(sets[j]) - o)}
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(edges, "chain").collect()
    assert {r["component"] for r in got} == {0} and len(got) == 300


def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 16))
    rows = [*base, *(base[:40] + rng.normal(scale=0.05, size=(40, 16))), *base[:30]]
    data = [(i, [float(np.float32(x)) for x in v], i % 2 if i != 7 else None) for i, v in enumerate(rows)]
    data += [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [1.0, None] * 8, 1), (904, [], 1), (905, [1.0, 2.0], 1), (None, [1.0] * 16, 1)]
    return data, spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("x"))


def test_permutation_index(spark):
    catalog.ship(spark)
    data, table = vectors(spark)
    got = permutation_ann.search(table, F.col("vec_id") % 20 == 0, k=5).collect()
    good = [(i, np.array(v, float)) for i, v, _ in data if i is not None and v and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    hits = total = 0
    for q, v in good:
        if q % 20:
            continue
        scored = sorted(((-float(permutation_ann.dots(w[None, :], v)[0]), i) for i, w in good if i != q))
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        exact = {i: -s for s, i in scored}
        assert all(exact[i] == s for _, i, s in mine) and mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits += len({m[1] for m in mine} & {i for _, i in scored[:5]})
        total += 5
    assert hits / total >= 0.9


def test_hnsw_tells_one_id_in_two_labels_apart(spark):
    v, w = [1.0, 0.0], [0.0, 1.0]
    rows = [(5, 0, v), (6, 0, v), (7, 0, [0.999, 0.01]), (5, 1, v), (9, 1, [0.999, 0.01]), (8, 1, w), (-3, 2, v), (-3, 2, w)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in hnsw_dedup.near_duplicates(table).collect())
    assert got == [(-3, 0, -3), (-3, 0, -3), (5, 1, 5), (5, 2, 5), (6, 2, 5), (7, 2, 5), (8, 0, 8), (9, 1, 5)]


def test_audit_without_links_scans_the_cell():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(600, 16))
    unit[1::2] = unit[::2] + 0.01 * rng.normal(size=(300, 16))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    graph, q = hnsw_dedup.Graph(unit[:300]), unit[300:]
    a, b = hnsw_dedup.audited_links(graph, q, np.full(300, -1), 0.93)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(*[x.tolist() for x in np.nonzero(q @ unit[:300].T >= 0.93)], strict=True))
    a, b = hnsw_dedup.audited_links(hnsw_dedup.Graph(unit), unit, np.arange(600), 0.93, 2)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(*[x.tolist() for x in np.nonzero(unit @ unit.T >= 0.93)], strict=True))


def test_text_parts_keep_all_rows():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 3, None, "b" * 9, "", "c"]), pa.array(range(5))], names=["text", "k"])
    parts = list(common.text_parts(batch, 0, 4))
    assert len(parts) > 1 and pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert [p.num_rows for p in common.text_parts(batch.slice(0, 0), 0)] == [0]


def test_hnsw_equals_brute_force(spark):
    catalog.ship(spark)
    data, table = vectors(spark)
    got = {r["vec_id"]: r for r in hnsw_dedup.near_duplicates(table).collect()}
    good = [(i, np.array(v, float), label) for i, v, label in data if i is not None and v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    pairs = [(a, b) for a in range(len(good)) for b in range(a) if good[a][2] == good[b][2] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] / np.linalg.norm(good[a][1]) / np.linalg.norm(good[b][1]) >= 0.93]
    assert pairs
    root, links = unite(len(good), pairs), np.bincount([x for p in pairs for x in p], minlength=len(good))
    for k, (i, _, _) in enumerate(good):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (links[k], good[root[k]][0], good[root[k]][0] == i)
    for i in (7, 900, 901, 902, 903, 904):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert len(got) == len(data)


def brute_base(text):
    out = []
    for kind, pattern, flags, group, least in (
        ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A, 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 0, 18), ("hex", r"[0-9a-f]+", 0, 0, 16),
    ):
        out += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return sorted(out, key=lambda s: (s[0], ("assign", "access", "hex").index(s[2])))


def test_secret_base_spans(docs, odd):
    for df in (docs, odd):
        texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
        for r in secret_scan.scan(df).collect():
            base = brute_base(texts[r["doc_id"]])
            assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[2] == k for s in base) for k in ("assign", "access", "hex"))
            joined = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
            assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
            assert set(joined.split(",")) <= set(r["spans"].split(",")) or not joined


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('db_password = "hunter2!xyzQ9"', ["hunter2!xyzQ9"]), ('K = "s3cr3tV4lue!!"\npassword = K', ["s3cr3tV4lue!!"]),
        ('a="abc1"\nb="def2XYZ9"\napi_secret = a + b', ["abc1", "def2XYZ9"]), ('password: str = "Qwe12!rtYu"', ["Qwe12!rtYu"]),
        ("password_length = 12345678", []), ("passwd: changeme", []), ("at 12:30 tokens: many words", []), ('{"apiKey": "Zx9-11kkQwe"}', ["Zx9-11kkQwe"]),
    ],
)
def test_lexer(text, found):
    assert [text[s:e] for s, e, _ in secret_scan.lexed_spans(text)] == found


def test_redaction(odd):
    row = secret_scan.redact(odd).where("doc_id = 7").first()
    assert "abcDEF" not in row["text"] and row["n_chars"] == len(row["text"])


def test_lm_scores(docs, odd):
    model = sentencepiece_codec.read_model(catalog.vocabulary_path())
    for df in (docs, odd.select("doc_id", "text")):
        rows = df.collect()
        learn = [r for r in rows if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2]
        count = {}
        for r in learn:
            for w in [*words(r["text"]), b""]:
                count[w] = count.get(w, 0) + 1
        n, v = sum(count.values()), len(count)
        want = {}
        for r in rows:
            t = [*words(r["text"]), b""]
            want[r["doc_id"]] = (len(t), sum(w in count for w in t), n, sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in t))
        got = lattice_lm.score_documents(df, lattice_lm.learning_rule(), model).collect()
        assert len(got) == len(rows)
        for r in got:
            a, b, c, base = want[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (a, b, c)
            assert r["base_score"] == pytest.approx(base, rel=1e-9) and math.isfinite(r["score"]) and r["score"] < 0


def test_lm_score_equals_a_plain_fit_and_sum(docs):
    model = sentencepiece_codec.read_model(catalog.vocabulary_path())
    rows = docs.collect()
    count, ends = {}, 0
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            ends += 1
            for w in words(r["text"]):
                count[w] = count.get(w, 0) + 1
    plain = lattice_lm.existing(model)
    each, in_bytes = plain.expect([w.decode(errors="replace") for w in count], np.array(list(count.values()), float))
    each, in_bytes, ends = each + lattice_lm.SMOOTH, in_bytes + 256 * lattice_lm.SMOOTH, ends + lattice_lm.SMOOTH
    total = each.sum() + in_bytes + ends
    own = lattice_lm.Lattice(plain.pieces, np.log(each / total), math.log(in_bytes / 256 / total))
    distinct = sorted({w for r in rows for w in words(r["text"])})
    value = dict(zip(distinct, own.scores([w.decode(errors="replace") for w in distinct]), strict=True))
    got = {r["doc_id"]: r["score"] for r in lattice_lm.score_documents(docs, lattice_lm.learning_rule(), model).collect()}
    for r in rows:
        want = (sum(value[w] for w in words(r["text"])) + math.log(ends / total)) / math.log(10)
        assert got[r["doc_id"]] == pytest.approx(want, rel=1e-9)


def test_lattice_sums_all_segmentations():
    own = lattice_lm.Lattice(["▁", "a", "b", "ab", "▁a", "ba"], np.log(np.array([0.1, 0.2, 0.1, 0.15, 0.05, 0.07])), math.log(0.001))
    p = dict(zip(own.pieces, np.exp(own.logs[:-1]), strict=True))

    def total(s):
        return 1.0 if not s else sum((p.get(s[:k]) or (0.001 ** len(s[0].encode()) if k == 1 else 0.0)) * total(s[k:]) for k in range(1, len(s) + 1))

    found = ["ab", "abba", "é", "bé" * 3, "a"]
    assert own.scores(found) == pytest.approx([math.log(total("▁" + w)) for w in found])
    counts, in_bytes = own.expect(["a"], np.ones(1))
    assert in_bytes == 0 and counts @ [1, 1, 1, 2, 2, 2] == pytest.approx(2.0)


def test_toxicity_on_held_out_rows(spark):
    catalog.ship(spark)
    rng = np.random.default_rng(5)
    plain = ["".join(rng.choice(list("aeioulnrt"), 5)) for _ in range(300)]
    rows = []
    for i in range(600):
        toxic = int(i % 3 == 0)
        w = list(rng.choice(plain, int(rng.integers(5, 60))))
        if toxic:
            for k in rng.integers(0, len(w), 1 + len(w) // 15):
                w[k] = str(rng.choice(["zgrumpkz", "zgrumpkzes", "xzgrumpk"]))
        rows.append((i, " ".join(w), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.where("doc_id % 5 <> 0"), docs.select("doc_id", "toxic"))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.predict(docs, model, ["doc_id"]).collect()}
    assert np.mean([got[i] == t for i, _, t in rows if i % 5 == 0]) >= 0.9
    scorer = toxicity.Scorer(model)
    a, b, empty = scorer.scores(["un zgrumpkk la", "un lorat la", None])
    assert a > b and 0 <= empty <= 1


def test_language_on_held_out_rows(spark, odd):
    catalog.ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = catalog.q_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) >= 0.95
    model = language_id.fit(docs)
    und = {r["doc_id"] for r in language_id.predict(odd, model, ["doc_id"]).where("lang_pred = 'und'").collect()}
    assert und == {2, 3, 4, 8}


def test_targets():
    assert mixing.targets([100, 100, 100]) == pytest.approx([200, 500 / 3, 250 / 3])
    t = mixing.targets([10, 1000, 1000])
    assert t[0] == 20 and sum(t) == pytest.approx(1.5 * 2010) and t[1] == pytest.approx(2995 * 2 / 3) and t[2] == pytest.approx(2995 / 3)
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 5)) == list(range(n))


def test_mixing(docs, odd):
    for df in (docs, odd.drop("size")):
        got = mixing.taken_counts(df).collect()
        assert len(got) == df.count()
        assert sorted(r["size"] for r in got) == sorted(len(words(r["text"])) for r in df.collect())
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.taken_counts(df).collect()), key=str)
        per = {}
        for r in got:
            key = (r["source_size"], r["target"])
            per[key] = per.get(key, 0) + r["taken"]
        for (_, target), taken in per.items():
            assert abs(taken - target) <= 0.02 * target + 4 * mixing.BLOCK_WORDS
    blocks = mixing.mixed_blocks(docs.select("doc_id", "text", "source")).groupBy("doc_id").agg(F.sum("words").alias("w"))
    assert {r["doc_id"]: r["w"] for r in blocks.collect()} == {r["doc_id"]: r["taken"] for r in mixing.taken_counts(docs).collect() if r["taken"]}


def test_pipeline_stages(spark, docs):
    """Every stage against a plain version of it on that stage's own input."""
    columns = docs.columns
    after = {}
    df = docs
    for name, stage in corpus_pipeline.STAGES:
        before, df = df, corpus_pipeline.pin(stage(spark, df, SF), "test")
        after[name] = (before, df)
        if name != "sentencepiece":
            assert df.columns == columns
    model = tuple(language_id.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")))
    kept = {r["doc_id"] for r in docs.collect() if (c := language_id.classify(r["text"], model))[0] != "und" and c[2] >= language_id.MIN_MARGIN}
    assert {r["doc_id"] for r in after["language_id"][1].collect()} == kept and len(kept) >= 0.9 * docs.count()
    rows = sorted((r["doc_id"], r["text"]) for r in after["ngram_join"][0].collect())
    sets = [grams(t, 5) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * (o := len(sets[i] & sets[j])) >= 80 * (len(sets[i]) + len(sets[j]) - o)]
    root = unite(len(rows), pairs)
    assert {r["doc_id"] for r in after["ngram_join"][1].collect()} == {rows[i][0] for i in range(len(rows)) if root[i] == i}
    texts = {r["doc_id"]: r["text"] for r in after["secret_scan"][0].collect()}
    assert {r["doc_id"]: r["text"] for r in after["secret_scan"][1].collect()} == {i: secret_scan.mask(t) for i, t in texts.items()}
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_counts(after["mixing"][0]).collect() if r["taken"]}
    assert {r["doc_id"]: len(words(r["text"])) for r in after["mixing"][1].collect()} == taken
    texts = {r["doc_id"]: r["text"] for r in after["sentencepiece"][0].collect()}
    assert {r["doc_id"]: r["decoded"] for r in after["sentencepiece"][1].collect()} == texts
    whole = {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {r["doc_id"]: r["ids_sha256"] for r in after["sentencepiece"][1].collect()}
