"""Words that lie in a passage standing anywhere else, by one FM-index a shard.

A passage (window) is ``WINDOW`` words in a row, compared as they are.

1. *Places.*  Of every window the leftmost smallest hashed ``SEED``-gram is chosen,
   so equal windows choose the same words.  Windows that chose the same place are
   a *place*; a place's words are a *piece*, and each window lies in just one.
   Seeds that a bounded sample shows to be frequent are chosen last, so that common
   passages do not gather all their surroundings; this steers the work only.
2. *Candidates.*  A place whose seed stands nowhere else repeats nothing.  Of the
   others each different piece is kept once, with how often it stands in the
   corpus.  Seeds of more than ``HOT`` places with different pieces are
   split: their windows become pieces of their own, dealt by their whole hash.
3. *Shards.*  Pieces go to shards by their seed, so equal windows share a shard, and
   every document is streamed against just the shards that can match it.  A shard
   is an FM-index of its pieces (``fm_index``): backward search over a wavelet matrix
   gives the matching statistics of each piece, weighted by how often pieces
   stand in the corpus; the stretches of at least ``WINDOW`` words that stand twice
   are reported.
4. *Back.*  Reported stretches are joined to all places of their piece (hot pieces
   are salted by their count), gathered by document, and cut.

Seeds, pieces (each with its seed) and texts (each with its id) are told apart by
64-bit hashes; inside a shard the words themselves are compared.

Defined results: a null, empty or white-space text has no words, and what is kept is
the empty string; fewer words than a window stay whole; rows are documents, also
with equal ids or null ones, so repeated rows remove each other's windows;
passages that overlap themselves count.  Only ``doc_id`` and ``text`` are read;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, partitions, pin
from .fm_index import FMIndex

WINDOW, SEED = 35, 16
#: About how many texts are sampled to find frequent seeds (four times as many at most; choice of places only).
ORDER_SAMPLE, FREQUENT, MOST_FREQUENT = 4000, 8, 100_000
HOT = 32_768
#: Words of a shard, about.
SHARD_WORDS = 1 << 17
#: Places of a piece that are joined in one task, about.
SALTED = 4096

_NULL_ID = -(2**63)
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BACK = pow(_STEP, -1, 1 << 64)
_LATE = np.uint64(1 << 63)


class Stretches:
    """Hashes of the word stretches of one text, from running sums."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        with np.errstate(over="ignore"):
            self.back = np.cumprod(np.r_[np.uint64(1), np.full(n, _BACK, np.uint64)])
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(each * np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), _STEP, np.uint64)])[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def chosen(order: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest of every ``width`` neighbours, by doubling."""
    best, reach = np.arange(len(order)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[:-step], best[step:]
        best = np.where(order[right] < order[left], right, left)
        reach += step
    return best


def places(words: list[bytes], window: int, seed: int, frequent: np.ndarray) -> tuple[np.ndarray, ...]:
    """(seed hash, piece hash, first window, windows) of a text's places."""
    if len(words) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    t = Stretches(words)
    at = np.arange(len(words) - seed + 1)
    grams = t.of(at, at + seed)
    order = grams >> np.uint64(1)
    if len(frequent):
        near = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
        order = np.where(frequent[near] == grams, order | _LATE, order)
    best = chosen(order, window - seed + 1)
    first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
    count = np.diff(np.r_[first, len(best)])
    piece = t.of(first, first + count - 1 + window)
    return grams[best[first]].view(np.int64), piece.view(np.int64), first, count


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) for p in parts])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), kind))


def _parts(batches, rows: int = 256):
    """Slices of few rows, so that long texts do not become Python objects all at once."""
    for batch in batches:
        yield from (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def frequent_seeds(rows: DataFrame, seed: int) -> np.ndarray:
    """Seeds that stand in several texts of a bounded sample, drawn by hash so that no task gathers rows of all others."""
    share = max(1, rows.count() // ORDER_SAMPLE)
    sample = rows.where((F.pmod(F.xxhash64("id", "same"), F.lit(share)) == 0) & F.col("data").isNotNull()).select("data").limit(4 * ORDER_SAMPLE)

    def run(batches):
        for part in _parts(batches):
            for data in part.column(0):
                words = data.as_py().split()
                at = np.arange(max(len(words) - seed + 1, 0))
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(Stretches(words).of(at, at + seed)).view(np.int64))], names=["seed"])

    found = sample.repartition(partitions(rows)).mapInArrow(run, "seed bigint").groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    found = found.where(F.col("n") >= FREQUENT).orderBy(F.col("n").desc(), "seed").limit(MOST_FREQUENT).collect()
    return np.sort(np.array([r["seed"] for r in found], np.int64).view(np.uint64))


def _described(rows: DataFrame, window: int, seed: int, frequent: np.ndarray) -> DataFrame:
    def run(batches):
        for part in _parts(batches):
            found = [places(data.as_py().split(), window, seed, frequent) for data in part.column(2)]
            columns = [*part.columns[:2], *(_lists([f[k] for f in found], pa.int64() if k < 2 else pa.int32()) for k in range(4))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "same", "seeds", "pieces", "firsts", "counts"])

    return rows.where("data is not null").mapInArrow(run, "id bigint, same bigint, seeds array<bigint>, pieces array<bigint>, firsts array<int>, counts array<int>")


def _repeated(found: DataFrame) -> DataFrame:
    """The places (id, same, seed, piece, first, windows) whose seed stands elsewhere too, with its count and whether its pieces differ."""
    seeds = found.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), (F.min("piece") < F.max("piece")).alias("differ")).where("n > 1")
    return found.join(pin(seeds, "substring-seeds"), "seed")  # a written side lets Spark split a seed that is hot on the other


def _windows(rows: DataFrame, hot: DataFrame, window: int) -> DataFrame:
    """The windows of hot places, each a place of its own whose seed is all its words."""
    lists = hot.groupBy("id", "same").agg(F.collect_list("first").alias("firsts"), F.collect_list("windows").alias("counts"))
    texts = rows.join(lists, ["id", "same"]).select("id", "same", "data", "firsts", "counts")

    def run(batches):
        for part in _parts(batches, 1):
            first, count = part.column(3).flatten().to_numpy(), part.column(4).flatten().to_numpy()
            start = np.unique(np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum()))
            piece = Stretches(part.column(2)[0].as_py().split()).of(start, start + window).view(np.int64)
            ids = [pa.array(np.full(len(start), part.column(k)[0].as_py(), np.int64)) for k in (0, 1)]
            seeds = mix64(piece.view(np.uint64), 5).view(np.int64)
            yield pa.RecordBatch.from_arrays([*ids, pa.array(seeds), pa.array(piece), pa.array(start, pa.int32()), pa.array(np.ones(len(start), np.int32))], names=["id", "same", "seed", "piece", "first", "windows"])

    return texts.mapInArrow(run, "id bigint, same bigint, seed bigint, piece bigint, first int, windows int")


def candidates(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """All places whose seed stands elsewhere too."""
    described = pin(_described(rows, window, seed, frequent_seeds(rows, seed)), "substring-places")
    each = described.select("id", "same", F.explode(F.arrays_zip("seeds", "pieces", "firsts", "counts")).alias("p"))
    each = each.select("id", "same", F.col("p.seeds").alias("seed"), F.col("p.pieces").alias("piece"), F.col("p.firsts").alias("first"), F.col("p.counts").alias("windows"))
    found = pin(_repeated(each), "substring-candidates")
    hot = found.where((F.col("n") > HOT) & F.col("differ"))
    if hot.limit(1).count():
        split = pin(_windows(rows, hot, window), "substring-windows")
        found = found.where((F.col("n") <= HOT) | ~F.col("differ")).unionByName(_repeated(split))
    return found


def _texts(rows: DataFrame, entries: DataFrame, window: int, shards: int) -> DataFrame:
    """The pieces with their words, read from the text that holds them."""
    one = F.struct("seed", "piece", "first", "windows", "times", "n")
    lists = entries.groupBy("id", "same").agg(F.collect_list(one).alias("held"))
    texts = rows.join(lists, ["id", "same"]).select("data", "held")

    def run(batches):
        for part in _parts(batches, 16):
            for data, held in zip(part.column(0), part.column(1), strict=True):
                words = data.as_py().split()
                fields = held.values.flatten()
                first, windows = fields[2].to_numpy(), fields[3].to_numpy()
                pieces = [b" ".join(words[a : a + c - 1 + window]) for a, c in zip(first.tolist(), windows.tolist(), strict=True)]
                shard = (mix64(fields[0].to_numpy().view(np.uint64), 3) % np.uint64(shards)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(shard), fields[0], fields[1], fields[4], fields[5], pa.array(pieces, pa.binary())], names=["shard", "seed", "piece", "times", "n", "words"])

    return texts.mapInArrow(run, "shard bigint, seed bigint, piece bigint, times bigint, n bigint, words binary")


def search_shard(pieces: list[bytes], times: np.ndarray, window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per piece the runs (first window, windows) that the shard holds at least twice."""
    words = [p.split() for p in pieces]
    size = np.array([len(w) + 1 for w in words])
    numbers = pa.array([w for ws in words for w in [*ws, None]], pa.binary()).dictionary_encode()
    symbols = numbers.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    index = FMIndex(symbols, np.repeat(np.minimum(times, 2), size), int(size.max()))
    twice = index.statistics(symbols, start, end, window) >= window
    edges = np.diff(np.r_[0, twice.astype(np.int8), 0])  # a separator ends every piece, so runs do not touch
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    cut = np.searchsorted(first, np.r_[start, len(symbols)])
    return [(first[a:b] - s, last[a:b] - first[a:b]) for s, a, b in zip(start, cut[:-1], cut[1:], strict=True)]


def _reported(pieces: DataFrame, window: int) -> DataFrame:
    """Searches each shard; a row per piece with repeated stretches."""
    dealt = pieces.repartition(partitions(pieces), "shard").sortWithinPartitions("shard")

    def result(held: list[pa.RecordBatch]):
        shard = pa.Table.from_batches(held)
        runs = search_shard(shard.column("words").to_pylist(), shard.column("times").to_numpy(), window)
        hit = np.flatnonzero([len(r[0]) for r in runs])
        kept = shard.select(["seed", "piece", "n"]).take(pa.array(hit)).combine_chunks()
        lists = [_lists([runs[i][k] for i in hit], pa.int32()) for k in range(2)]
        return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in kept.columns), *lists], names=["seed", "piece", "n", "offsets", "lengths"])

    def run(batches):
        held, current = [], None  # the rows of the shard at hand
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            for a, b in zip(edge := np.r_[0, np.flatnonzero(np.diff(shards)) + 1, len(shards)], edge[1:], strict=False):
                if a == b:
                    continue
                if held and shards[a] != current:
                    yield result(held)
                    held = []
                current = shards[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield result(held)

    return dealt.mapInArrow(run, "seed bigint, piece bigint, n bigint, offsets array<int>, lengths array<int>")


def _covered(n: int, marks: pa.ListScalar | None, window: int) -> np.ndarray:
    """Which of n words lie in a reported stretch."""
    if marks is None or not marks.is_valid:
        return np.zeros(n, bool)
    first, offsets, lengths = marks.values.flatten()
    count = np.diff(offsets.offsets.to_numpy())
    start = np.repeat(first.to_numpy(), count).astype(np.int64) + offsets.flatten().to_numpy()
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + lengths.flatten().to_numpy() - 1 + window, -1)
    return np.cumsum(edge[:n]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, with_text: bool = True) -> DataFrame:
    """Per document its words, how many of them stand in a repeated passage, and the others.

    ``spans`` are the removed stretches (start:end in words, end exclusive, comma
    joined), ``kept`` the other words joined by one space (left out
    without ``with_text``), ``kept_sha256`` its digest.
    """
    if not 0 < seed <= window:
        raise ValueError("a seed must not be longer than a window")
    doc_id, text = F.col("doc_id").cast("long"), F.col("text")
    rows = docs.select(F.coalesce(doc_id, F.lit(_NULL_ID)).alias("id"), F.xxhash64("text").alias("same"), text.cast("binary").alias("data"))
    found = candidates(rows, window, seed)
    holder = F.min(F.struct("id", "same", "first", "windows")).alias("one")
    entries = found.groupBy("seed", "piece").agg(holder, F.count(F.lit(1)).alias("times"), F.max("n").alias("n"))
    entries = pin(entries.select("seed", "piece", "times", "n", "one.*"), "substring-entries")
    words = entries.agg(F.sum(F.col("windows") + window)).first()[0] or 0
    reported = _reported(_texts(rows, entries, window, int(words // SHARD_WORDS) + 1), window)

    salts = F.floor(F.col("n") / SALTED).cast("int")
    each = reported.withColumn("salt", F.explode(F.sequence(F.lit(0), salts))).drop("n")
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id", "same"), salts + 1).cast("int"))
    marks = salted.join(each, ["seed", "piece", "salt"]).groupBy("id", "same").agg(F.collect_list(F.struct("first", "offsets", "lengths")).alias("marks"))
    marked = rows.join(marks, ["id", "same"], "left").select("id", "data", "marks")

    def run(batches):
        for part in _parts(batches):
            out = []
            for data, held in zip(part.column(1), part.column(2), strict=True):
                words = (data.as_py() or b"").split()
                gone = _covered(len(words), held, window)
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if len(edges) else words)
                spans = ",".join([f"{a}:{b}" for a, b in edges.reshape(-1, 2).tolist()])
                out.append((len(words), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            ids = [None if i == _NULL_ID else i for i in part.column(0).to_pylist()]
            columns = list(zip(*out, strict=True)) or [()] * 5
            arrays = [pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            arrays[-1] = arrays[-1].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays[: len(names)], names=names)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = ["doc_id", "n_words", "n_removed", "spans", "kept_sha256", "kept"][: 6 if with_text else 5]
    return marked.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, spans string, kept_sha256 string" + (", kept string" if with_text else ""))
