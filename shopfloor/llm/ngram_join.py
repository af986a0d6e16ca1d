"""N-gram Jaccard join with a prefix tree.

Texts become sets of word n-grams (64-bit hashes); two documents link when the
Jaccard similarity of their sets reaches a percentage.  Equal sets are one node
first.  N-grams have one global order: those that a bounded sample shows to be
frequent come last, all others by hash; the order steers the work only, never
the result.

1. *Suspects.*  Of two linked sets, the first ``n - ceil(t n) + l`` n-grams of
   either must share ``l``.  So each set posts that prefix, n-grams posted by
   one set alone are forgotten, and sets left with fewer shared ones than any
   partner of theirs demands drop out.
2. *Prefix tree.*  Each suspect goes, with its whole set, to the block of the
   most shared n-gram of its prefix.  A block stores its ordered sets in a trie;
   one walk over the trie carries, for the shared path of all sets below, the
   overlaps with every other set of the block, and a subtree is left with only
   those partners that its remaining lengths can still bring to the threshold.
   Its links, as a spanning forest, are united into components.
3. *The rest.*  Linked sets of different blocks share posted n-grams all the
   same.  Under every posted n-gram, pairs of suspects of different components
   are tested by size and by a bound on their overlap from bitmaps of their sets
   (never too small, so nothing is lost) and verified on the whole sets: first
   the likeliest pair of two components, which unites nearly all that belongs
   together, then all that meet under as many n-grams as linked prefixes must.

Scale: groups of equal sets meet only in partial aggregates; blocks have at most
about ``BLOCK_SETS`` sets and cells ``CELL_ROWS`` rows (a larger one is dealt to
chunks, or to pairs of chunks); links are never listed pair by pair, only forest
edges are.  Components are computed by Spark; links and fingerprints do not
reach the driver.

Defined results: null, empty or white-space texts have the empty set, size 0,
and link with nothing; with fewer words than n the whole sequence is one n-gram;
rows that share an id are one document (each row keeps its own size); a null id
has no component; texts are read whole; an empty table gives an empty result.
Only ids and texts are read; other columns do not matter.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, connected_components, hash_share, holds, mix64, partitions, pin
from .hnsw_dedup import forest

WORDS, PERCENT = 4, 85
#: Documented bound of the sample that finds frequent n-grams (order only).
ORDER_SAMPLE, FREQUENT, MOST_FREQUENT = 4000, 8, 100_000
BLOCK_SETS = 4096
CELL_ROWS = 2048
BITS = 1024
#: Places of the marks that tell most texts that are not wanted (work only, never the result).
MARKS = 1 << 24
_K = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
_BYTE = mix64(np.arange(256, dtype=np.uint64), 77)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32]).astype(np.int8)
_power = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _forget() -> None:
    _power[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


holds("ngram_join", _forget)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of every word (A-Z lowered), from running sums over the bytes:
    a word's polynomial is a difference of two sums, moved to the origin."""
    b = np.frombuffer(text.lower(), np.uint8)
    n = len(b)
    if n > len(_power[0]):
        size = 1 << n.bit_length()
        with np.errstate(over="ignore"):
            _power[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size, base)]) for base in (_BASE, _INVERSE)]
    gap = np.ones(n + 2, np.int8)
    gap[1:-1] = _SPACE[b]
    step = np.diff(gap)
    start, end = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[b] * _power[0][:n], out=sums[1:])
        return mix64((sums[end] - sums[start]) * _power[1][start] + (end - start).astype(np.uint64))


def shingles(text: bytes | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams (A-Z lowered)."""
    a = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(a):
        return a
    k = min(n, len(a))
    with np.errstate(over="ignore"):
        h = a[: len(a) - k + 1].copy()
        for j in range(1, k):
            h = h * _K + a[j : len(a) - k + 1 + j]
        h = np.sort(mix64(h, k))
    return h[np.r_[True, h[1:] != h[:-1]]]


def needed(n_a: int, n_b, percent: int):
    """Least overlap of linked sets of these sizes: o / (a + b - o) >= percent / 100."""
    return -(-(percent * (n_a + n_b)) // (100 + percent))


def margin(n: int) -> int:
    """How many n-grams two prefixes have to share, by the smaller size."""
    return 1 + n // 20


def prefix_size(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + margin(n))


def ordered(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """A sorted set in the global order: frequent n-grams last."""
    if not len(frequent) or not len(s):
        return s
    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
    late = frequent[at] == s
    return np.concatenate([s[~late], s[late]]) if late.any() else s


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parities of the set's members over BITS cells."""
    cell = np.bincount((s >> np.uint64(20)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(cell.astype(np.uint8)).view(np.uint64)


def trie_join(sets: list[np.ndarray], frequent: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i < j) of linked sets, by one walk over the trie of the ordered sets."""
    size = np.array([len(s) for s in sets], np.int64)
    g = len(sets)
    empty = np.zeros(0, np.int64)
    if g < 2:
        return empty, empty
    flat = np.concatenate(sets)
    tokens, number, df = np.unique(flat, return_inverse=True, return_counts=True)
    # members of one set alone count in sizes only
    late = np.isin(tokens, frequent) if len(frequent) else np.zeros(len(tokens), bool)
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, late))] = np.arange(len(tokens))
    owner = np.repeat(np.arange(g), size)
    shared = df[number] > 1
    r, o = rank[number[shared]], owner[shared]
    order = np.lexsort((r, o))
    r, o = r[order], o[order]
    length = np.bincount(o, minlength=g)
    start = np.cumsum(length) - length
    paths = [r[a : a + n] for a, n in zip(start, length, strict=True)]
    by_token = np.lexsort((o, r))
    posted, edge = o[by_token], np.searchsorted(r[by_token], np.arange(len(tokens) + 1))
    line = sorted(range(g), key=lambda i: paths[i].tolist())
    common = np.zeros(g, np.int64)  # of a path with the one before it
    for k in range(1, g):
        a, b = paths[line[k - 1]], paths[line[k]]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        common[k] = differ[0] if len(differ) else m
    line_at = np.array(line)
    first, second = [], []
    stack = [(0, g, 0, np.arange(g), np.zeros(g, np.int64))]
    while stack:
        lo, hi, depth, partners, overlap = stack.pop()
        path = paths[line[lo]]
        end = int(common[lo + 1 : hi].min()) if hi - lo > 1 else len(path)
        if end > depth:  # the stretch that all sets of this subtree share
            met = np.concatenate([posted[edge[t] : edge[t + 1]] for t in path[depth:end]])
            overlap = overlap + np.bincount(met, minlength=g)[partners]
        members = line_at[lo:hi]
        left = int((length[members] - end).max())
        least = needed(int(size[members].min()), size[partners], percent)
        alive = overlap + np.minimum(left, length[partners] - overlap) >= least
        partners, overlap = partners[alive], overlap[alive]
        if not len(partners):
            continue
        if hi - lo == 1 or left == 0:
            for x in members:
                union = size[x] + size[partners] - overlap
                hit = partners[(100 * overlap >= percent * union) & (partners > x) & (overlap > 0)]
                first.append(np.full(len(hit), x))
                second.append(hit)
            continue
        cuts = [lo, *(lo + 1 + np.flatnonzero(common[lo + 1 : hi] == end)).tolist(), hi]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            stack.append((a, b, end, partners, overlap))
    return (np.concatenate(first), np.concatenate(second)) if first else (empty, empty)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("data"))


def _frequent(docs: DataFrame, n: int) -> np.ndarray:
    near = hash_share(ORDER_SAMPLE, docs.count())
    sample = _texts(docs).where(near & F.col("data").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(ORDER_SAMPLE)

    def run(batches):
        claim("ngram_join")
        for batch in batches:
            found = [shingles(data, n) for data in batch.column(1).to_pylist()]
            t, k = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(k.astype(np.int64))], names=["t", "n"])

    rows = sample.repartition(8).mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    rows = rows.orderBy(F.col("n").desc(), "t").limit(MOST_FREQUENT).collect()
    return np.sort(np.array([r["t"] for r in rows], np.int64).view(np.uint64))


def _described(docs: DataFrame, n: int, percent: int, frequent) -> DataFrame:
    """(doc_id, n, f1, f2, prefix, bits): size, fingerprint, prefix in global order, bitmap."""

    def run(batches):
        claim("ngram_join")
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for at in range(0, len(texts), 512):
                size, f1, f2, prefix, bits = [], [], [], [], []
                for data in texts[at : at + 512]:
                    s = shingles(data, n)
                    size.append(len(s))
                    with np.errstate(over="ignore"):
                        f1.append(mix64(s, 101).sum(dtype=np.uint64))
                        f2.append(mix64(s, 202).sum(dtype=np.uint64))
                    prefix.append(ordered(s, frequent.value)[: prefix_size(len(s), percent)].tobytes())
                    bits.append(bitmap(s).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(size)), pa.array(size, pa.int32()), pa.array(np.array(f1, np.uint64).view(np.int64)), pa.array(np.array(f2, np.uint64).view(np.int64)), pa.array(prefix, pa.binary()), pa.array(bits, pa.binary())],
                    names=["doc_id", "n", "f1", "f2", "prefix", "bits"],
                )

    return _texts(docs).mapInArrow(run, "doc_id bigint, n int, f1 bigint, f2 bigint, prefix binary, bits binary")


def _postings(nodes: DataFrame) -> DataFrame:
    def run(batches):
        claim("ngram_join")
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                data = part.column(1).to_pylist()
                each = np.array([len(d) // 8 for d in data])
                flat = np.frombuffer(b"".join(data), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(np.repeat(part.column(0).to_numpy(), each))], names=["t", "node"])

    return nodes.select("node", "prefix").mapInArrow(run, "t bigint, node bigint")


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` without most of those whose doc_id is not in ``ids``, and without none that
    is: ids are told by their hash among MARKS, in a table of at most MARKS / 64 rows that
    every task holds, so that rows that are not wanted are not shuffled."""
    word, bit = F.expr(f"cast(pmod(xxhash64(doc_id), {MARKS}) div 64 as int)"), F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id), 64) as int))")
    marks = ids.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    met = rows.withColumn("__word", word).join(F.broadcast(marks), "__word")
    return met.where(F.col("__bits").bitwiseAND(bit) != 0).drop("__word", "__bits")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, data) of the wanted nodes: whole texts, which take half the room of their
    sets.  Rows that share an id may hold several texts; equal ones are one."""
    ids = wanted.select(F.col("node").alias("doc_id")).distinct()
    again = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    ids = ids.join(again, "doc_id", "left").select("doc_id", F.col("k").isNotNull().alias("again"))
    # an inner join by distinct ids: the optimizer would push a semi-join below the marks
    rows = _marked(_texts(docs), ids).join(ids, "doc_id").select(F.col("doc_id").alias("node"), "data", "again")
    return rows.where("not again").drop("again").unionByName(rows.where("again").drop("again").dropDuplicates(["node", "data"]))


def _block_links(texts: DataFrame, n: int, percent: int, frequent) -> DataFrame:
    """Forest edges (a, b) of the links inside each (block, chunk)."""

    def run(table):
        claim("ngram_join")
        nodes = table.column("node").to_numpy()
        sets = [shingles(d.as_py(), n) for d in table.column("data")]
        a, b = trie_join(sets, frequent.value, percent)
        x, y = forest(nodes[a], nodes[b])
        return pa.table([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    return texts.groupBy("block", "chunk").applyInArrow(run, "a bigint, b bigint")


def _cell_pairs(rows: DataFrame, percent: int, n_parts: int, likeliest: bool) -> DataFrame:
    """Candidate pairs of different components, which share as many posted n-grams as they must: (a, b).

    ``likeliest``: only the best pair of two components in a cell, without that count.

    ``rows``: (t, df, node, comp, n, bits)."""
    chunked = rows.withColumn("c", F.expr(f"cast((df + {CELL_ROWS} - 1) div {CELL_ROWS} as int)")).withColumn("i", F.pmod(F.xxhash64("node"), F.col("c")).cast("int"))
    cells = chunked.select("t", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("j"), "i", "node", "comp", "n", "bits")
    cells = cells.select("t", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "node", "comp", "n", "bits")

    def judge(i, lo, hi, node, comp, n, bits):
        """Pairs of one cell (in a cell of two chunks, only across them)."""
        if (comp == comp[0]).all():
            return None
        order = np.argsort(n, kind="stable")
        i, node, comp, n, bits = i[order], node[order], comp[order], n[order], bits[order]
        bits = np.stack([np.frombuffer(b, np.uint64) for b in bits])
        a_all, b_all, s_all = [], [], []
        top = np.searchsorted(n, 100 * n // percent, side="right")  # sizes that can still link
        for k in range(len(n) - 1):
            cand = np.arange(k + 1, top[k])
            ok = comp[cand] != comp[k]
            if lo != hi:
                ok &= i[cand] != i[k]
            cand = cand[ok]
            if not len(cand):
                continue
            apart = np.bitwise_count(bits[cand] ^ bits[k]).sum(axis=1).astype(np.int64)
            most = (n[cand] + n[k] - apart) // 2
            good = most >= needed(int(n[k]), n[cand], percent)
            cand = cand[good]
            s_all.append(most[good] / (n[cand] + n[k]))
            a_all.append(np.full(len(cand), k))
            b_all.append(cand)
        if not a_all:
            return None
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        if likeliest and len(a):
            ca, cb = np.minimum(comp[a], comp[b]), np.maximum(comp[a], comp[b])
            order = np.lexsort((-np.concatenate(s_all), cb, ca))
            ca, cb = ca[order], cb[order]
            head = order[np.r_[True, (ca[1:] != ca[:-1]) | (cb[1:] != cb[:-1])]]
            a, b = a[head], b[head]
            return np.minimum(node[a], node[b]), np.maximum(node[a], node[b]), np.zeros(len(a), np.int64)
        return np.minimum(node[a], node[b]), np.maximum(node[a], node[b]), margin(n[a])  # a is the smaller set

    def run(batches):
        claim("ngram_join")
        held: list = []
        seen: Counter = Counter()

        def close():
            t = pa.Table.from_batches(held) if held else None
            held.clear()
            if t is None or t.num_rows < 2:
                return
            c = {k: t.column(k).to_numpy() for k in ("i", "node", "comp", "n")}
            got = judge(c["i"], t.column("lo")[0].as_py(), t.column("hi")[0].as_py(), c["node"], c["comp"], c["n"].astype(np.int64), np.array(t.column("bits").to_pylist(), object))
            if got:
                seen.update(zip(*[g.tolist() for g in got], strict=True))

        def out():
            flat = list(seen.items())
            seen.clear()
            return pa.RecordBatch.from_arrays([*[pa.array([p[i] for p, _ in flat], pa.int64()) for i in range(3)], pa.array([k for _, k in flat], pa.int64())], names=["a", "b", "least", "k"])

        last = None
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)], axis=1)
            cuts = [0, *(1 + np.flatnonzero((key[1:] != key[:-1]).any(axis=1))).tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                here = tuple(key[a].tolist()) if b > a else last
                if here != last:
                    close()
                    last = here
                    if len(seen) > 200_000:
                        yield out()
                held.append(batch.slice(a, b - a))
        close()
        if seen:
            yield out()

    met = cells.repartition(n_parts, "t", "lo", "hi").sortWithinPartitions("t", "lo", "hi").mapInArrow(run, "a bigint, b bigint, least bigint, k bigint")
    return met.groupBy("a", "b").agg(F.sum("k").alias("k"), F.min("least").alias("least")).where("k >= least").select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (a written table), by their whole sets."""

    def run(batches):
        claim("ngram_join")
        for batch in batches:
            keep = []
            last, x = None, None
            for a, s, t in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                s = s.as_py()
                if (a, s) != last:
                    last, x = (a, s), shingles(s, n)
                y = shingles(t.as_py(), n)
                o = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * o >= percent * (len(x) + len(y) - o))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    used = texts.join(met, "node", "left_semi")
    left = used.select(F.col("node").alias("a"), F.col("data").alias("x"))
    right = used.select(F.col("node").alias("b"), F.col("data").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def classes(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    spark, parts = docs.sparkSession, partitions(docs)
    frequent = spark.sparkContext.broadcast(_frequent(docs, n))  # MOST_FREQUENT hashes at most
    described = pin(_described(docs, n, percent, frequent), "ngram-described")
    slim = described.select("doc_id", "n", "f1", "f2")
    heads = pin(slim.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node")), "ngram-heads")
    key = [described[k] == heads[k] for k in ("n", "f1", "f2")]
    nodes = described.join(heads, [described.doc_id == heads.node, *key], "left_semi").select(F.col("doc_id").alias("node"), "n", "prefix", "bits")

    # 1. suspects
    posted = _postings(nodes)
    df = posted.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = pin(posted.join(df, "t"), "ngram-shared")
    demand = F.lit(1) + F.floor(F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) / 20)
    popular = shared.groupBy("node").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("df", "t")).alias("m"))
    # rows that share an id may hold several sets: the smallest decides
    least = nodes.groupBy("node").agg(F.min("n").alias("n"))
    suspects = pin(least.join(popular, "node").where(F.col("k") >= demand).select("node", F.col("m.t").alias("block"), F.col("m.df").alias("df")), "ngram-suspects")

    # 2. prefix trees
    texts = pin(_texts_of(docs, suspects), "ngram-texts")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("df") / BLOCK_SETS)).cast("int")
    alone = suspects.groupBy("block").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    blocks = suspects.join(alone.select("block"), "block", "left_semi").withColumn("chunks", chunks)
    edges = None
    for turn in range(2):  # blocks of several chunks are dealt anew once, so that their chunks meet
        dealt = blocks.where("chunks > 1") if turn else blocks
        dealt = dealt.select("node", "block", F.pmod(F.xxhash64("node", F.lit(turn)), "chunks").cast("int").alias("chunk"))
        if turn and dealt.isEmpty():
            break
        links = pin(_block_links(texts.join(dealt, "node"), n, percent, frequent), f"ngram-edges{turn}")
        edges = links if edges is None else edges.unionByName(links)
    components = connected_components(edges, "ngram")

    # 3. links between blocks
    info = nodes.join(suspects.select("node"), "node", "left_semi").select("node", "n", "bits")
    for likeliest in (True, False):
        comp = info.select("node").distinct().join(components, "node", "left").select("node", F.coalesce("component", "node").alias("comp"))
        under = shared.join(comp, "node")
        mixed = under.groupBy("t").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("t")
        rows = under.join(mixed, "t", "left_semi")
        # a set can link outside its component only under enough n-grams that leave it
        enough = rows.groupBy("node").agg(F.count(F.lit(1)).alias("k")).join(info.where(f"n <= {BITS}") if likeliest else info, "node").where(F.col("k") >= demand).select("node", "n", "bits")
        rows = rows.join(enough, "node").select("t", "df", "node", "comp", "n", "bits")
        pairs = pin(_cell_pairs(rows, percent, parts, likeliest), "ngram-pairs")
        more = pin(_verified(pairs, texts, n, percent), "ngram-more")
        if not more.isEmpty():
            edges = edges.unionByName(more)
            components = connected_components(edges, "ngram-again")
    found = heads.join(components, "node", "left").select("n", "f1", "f2", F.coalesce("component", "node").alias("component"))
    linked = slim.where("n > 0 and doc_id is not null").join(found, ["n", "f1", "f2"]).select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))
    rest = slim.where("n = 0 or doc_id is null").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(rest)


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without all but the first (smallest id) document of each group of
    near duplicates.  Documents without words or without an id stay."""
    kept = classes(docs, n, percent).where("component_id = doc_id and doc_id is not null").select("doc_id").distinct()
    whole = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    return whole.unionByName(docs.where("doc_id is null"))
