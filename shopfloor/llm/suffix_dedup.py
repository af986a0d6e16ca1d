"""Passages that repeat across documents, by a sparse suffix array.

A passage is at least ``PASSAGE`` words; the result marks every word that lies
in some window of that many words which another document holds too.

1. *Sparse suffixes.*  Of every window the leftmost of its smallest hashed
   ``SEED``-grams is selected (a minimiser), so equal windows select the same
   place, and about one word in eighteen is retained.  A retained suffix
   stands for the run of windows that selected it; its context is the words
   from the first of these windows to the end of the last.
2. *Sort and compare neighbours.*  Suffixes of equal context are one entry.
   Entries are range partitioned and sorted by (first ``SEED`` words, context),
   both as hashes, which is an order of suffixes as good as the alphabet's.
   An entry whose neighbours begin otherwise repeats only as a whole.  The first
   and the last entry of a partition count as having a neighbour, so no entry
   must look across; that only costs work, as step 3 is exact.
3. *Extend.*  Entries with a neighbour are extended left and right from the
   shared words: each of their windows is compared, as a hash, with those of
   all other entries, in an aggregate that combines before it shuffles.

No step gathers the copies of a passage: equal texts are handled once, equal
contexts are combined in partial aggregates, a hot beginning is split by the
range partitioning, and the joins that remain have one row a key on one side.
Only the places of one text meet in a row.

Word and window hashes have 64 bits; equality of hashes is taken as equality.

Defined results: a null or empty text, or one shorter than a passage, repeats
nothing.  Each row is a document: repeated rows and equal texts repeat each
other wholly, if long enough.  What a document repeats within itself alone is
not marked.  The *earlier* of two documents is that of the smaller ``doc_id``, null
being last; rows of one id are none earlier.  Nulls and columns besides
``doc_id`` and ``text`` do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, partitions, pin
from .ngram_join import word_hashes

PASSAGE, SEED = 50, 16

_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BACK = pow(_STEP, -1, 1 << 64)
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_NULL_ID = -(2**63)


class Hashes:
    """Hashes of the word stretches of one text, from running sums."""

    def __init__(self, text: bytes):
        words = word_hashes(text) if text else np.zeros(0, np.uint64)
        self.n = n = len(words)
        with np.errstate(over="ignore"):
            self.back = np.cumprod(np.r_[np.uint64(1), np.full(n, _BACK, np.uint64)])
            up = np.cumprod(np.r_[np.uint64(1), np.full(n, _STEP, np.uint64)])
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(words * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def leftmost_smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest of every ``width`` neighbours, by doubling."""
    best, reach = np.arange(len(h)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[:-step], best[step:]
        best = np.where(h[right] < h[left], right, left)
        reach += step
    return best


def retained(text: bytes, passage: int = PASSAGE, seed: int = SEED) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, seed hash, context hash, first window, windows) of the retained suffixes."""
    t = Hashes(text)
    if t.n < passage:
        none = np.zeros(0, np.int64)
        return t.n, none, none, none, none
    at = np.arange(t.n - seed + 1)
    grams = t.of(at, at + seed)
    chosen = leftmost_smallest(grams, passage - seed + 1)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    count = np.diff(np.r_[first, len(chosen)])
    context = t.of(first, first + count - 1 + passage)
    return t.n, grams[chosen[first]].view(np.int64), context.view(np.int64), first, count


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) for p in parts])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _suffixes(rows: DataFrame, passage: int, seed: int) -> DataFrame:
    """A row a document: id, text hash, words and the lists of its retained suffixes."""

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                found = [retained(text.encode() if text else b"", passage, seed) for text in part.column(2).to_pylist()]
                columns = [part.column(0), part.column(1), pa.array([f[0] for f in found], pa.int64())]
                columns += [_lists([f[i] for f in found], pa.int64()) for i in (1, 2)]
                columns += [_lists([f[i] for f in found], pa.int32()) for i in (3, 4)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "same", "n_words", "seeds", "contexts", "firsts", "counts"])

    schema = "doc_id bigint, same bigint, n_words bigint, seeds array<bigint>, contexts array<bigint>, firsts array<int>, counts array<int>"
    return rows.mapInArrow(run, schema)


def _neighbours(entries: DataFrame) -> DataFrame:
    """Sorts the entries and marks those whose neighbour begins with the same words."""

    def run(batches):
        held = None  # the last entry waits for its right neighbour
        left = True  # nothing is known of what precedes the partition
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            seeds = batch.column("seed").to_numpy()
            equal = seeds[1:] == seeds[:-1]
            near = np.r_[left, equal] | np.r_[equal, True]
            last = batch.num_rows - 1
            if last:
                yield marked(batch.slice(0, last), near[:last])
                left = bool(equal[-1])
            held = batch.slice(last)
        if held is not None:
            yield marked(held, np.array([True]))

    def marked(batch, near):
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], names=[*batch.schema.names, "near"])

    spread = entries.repartitionByRange(partitions(entries), "seed", "context").sortWithinPartitions("seed", "context")
    schema = "seed bigint, context bigint, same bigint, at int, windows int, holder bigint, most bigint, earliest bigint, near boolean"
    return spread.mapInArrow(run, schema)


def _windows(rows: DataFrame, wanted: DataFrame, passage: int) -> DataFrame:
    """Every window of the wanted entries, read from the text of each entry's holder."""
    lists = wanted.groupBy("same", "holder").agg(F.collect_list(F.struct("context", "at", "windows", "most", "earliest")).alias("entries"))
    texts = rows.select("same", _id("doc_id").alias("holder"), "text").join(lists, ["same", "holder"]).select("same", "text", "entries")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                text = Hashes(batch.column(1)[i].as_py().encode())
                entries = pa.StructArray.from_arrays(batch.column(2)[i].values.flatten(), names=["context", "at", "windows", "most", "earliest"])
                at, count = entries.field("at").to_numpy(), entries.field("windows").to_numpy()
                each = np.repeat(np.arange(len(at)), count)
                offset = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                start = at[each] + offset
                taken = pa.array(each)
                columns = [pa.array(text.of(start, start + passage).view(np.int64)), entries.field("context").take(taken), pa.array(offset, pa.int32())]
                columns += [pa.array(np.full(len(each), batch.column(0)[i].as_py(), np.int64)), entries.field("most").take(taken), entries.field("earliest").take(taken)]
                yield pa.RecordBatch.from_arrays(columns, names=["window", "context", "offset", "same", "most", "earliest"])

    return texts.mapInArrow(run, "window bigint, context bigint, offset int, same bigint, most bigint, earliest bigint")


def _id(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(_NULL_ID))


def _order(column: str) -> Column:
    """An id as a number that puts null last."""
    return F.coalesce(F.col(column), F.lit(2**63 - 1))


def spans_of(starts: np.ndarray, passage: int) -> list[tuple[int, int]]:
    """Stretches of words covered by the windows that begin at ``starts``."""
    if not len(starts):
        return []
    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) > passage)
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + passage).tolist()))


def repeats(docs: DataFrame, passage: int = PASSAGE, seed: int = SEED) -> DataFrame:
    """One row per document that shares a passage with another one.

    ``spans`` are its repeated stretches, ``later_spans`` those that an earlier
    document holds (start:end in words, end exclusive, comma-joined), with the
    words in them as ``n_repeated`` and ``n_later``; ``text_hash`` tells texts apart.
    """
    if not 0 < seed <= passage:
        raise ValueError("a seed must not be longer than a passage")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("same"), "text")
    described = pin(_suffixes(rows, passage, seed), "suffix-retained").where(F.col("n_words") >= passage)
    texts = described.groupBy("same").agg(F.count(F.lit(1)).alias("n_rows"), F.min(_order("doc_id")).alias("text_first"))

    # each text once: its suffixes, taken from its earliest row
    places = (
        described.withColumn("text_first", _order("doc_id"))
        .join(texts.select("same", "text_first"), ["same", "text_first"])
        .select("same", "doc_id", "text_first", F.explode(F.arrays_zip("seeds", "contexts", "firsts", "counts")).alias("s"))
        .select("same", _id("doc_id").alias("holder"), "text_first", F.col("s.seeds").alias("seed"), F.col("s.contexts").alias("context"), F.col("s.firsts").alias("at"), F.col("s.counts").alias("windows"))
    )
    entries = places.groupBy("seed", "context").agg(
        F.min(F.struct("same", "at", "windows", "holder")).alias("one"), F.max("same").alias("most"), F.min("text_first").alias("earliest")
    ).select("seed", "context", "one.same", "one.at", "one.windows", "one.holder", "most", "earliest")
    entries = pin(_neighbours(entries).where("near or same < most"), "suffix-neighbours")

    # extension of the entries that have a neighbour; the others repeat as a whole
    windows = _windows(rows, entries.where("near"), passage)
    found = windows.groupBy("window").agg(F.min("same").alias("least"), F.max("most").alias("greatest"), F.min("earliest").alias("first_id"))
    extended = windows.select("window", "context", "offset").join(found.where("least < greatest").select("window", "first_id"), "window")
    whole = entries.where("not near").select("context", F.array(F.struct(F.lit(0).alias("offset"), F.col("windows"), F.col("earliest").alias("first_id"))).alias("runs"))
    single = F.struct("offset", F.lit(1).alias("windows"), "first_id")
    runs = extended.groupBy("context").agg(F.collect_list(single).alias("runs")).unionByName(whole)

    # back to the texts, then to their rows; a copy of an earlier text is later as a whole
    marks = places.select("same", "context", "at").join(runs, "context").groupBy("same").agg(F.collect_list(F.struct("at", "runs")).alias("marks"))
    repeated = texts.join(_spans(marks.join(texts, "same"), passage), "same", "left").where("n_rows > 1 or spans is not null")
    all_words, is_copy = F.concat(F.lit("0:"), F.col("n_words")), F.col("n_rows") > 1
    out = described.select("doc_id", "same", "n_words").join(repeated, "same").withColumn("later", _order("doc_id") > F.col("text_first"))
    return out.select(
        "doc_id",
        "n_words",
        F.when(is_copy, F.col("n_words")).otherwise(F.col("n_repeated")).alias("n_repeated"),
        F.when(F.col("later"), F.col("n_words")).otherwise(F.coalesce("n_later", F.lit(0))).alias("n_later"),
        F.when(is_copy, all_words).otherwise(F.col("spans")).alias("spans"),
        F.when(F.col("later"), all_words).otherwise(F.coalesce("later_spans", F.lit(""))).alias("later_spans"),
        F.col("same").alias("text_hash"),
    )


def _spans(texts: DataFrame, passage: int) -> DataFrame:
    """The stretches that a text shares with others, and those that a document before its earliest row holds."""
    names = ["same", "n_repeated", "n_later", "spans", "later_spans"]
    kinds = [pa.int64()] * 3 + [pa.string()] * 2

    def run(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                starts, firsts = _starts(batch.column(2)[i])
                every, later = spans_of(starts, passage), spans_of(starts[firsts < batch.column(1)[i].as_py()], passage)
                out.append((batch.column(0)[i].as_py(), sum(b - a for a, b in every), sum(b - a for a, b in later), _joined(every), _joined(later)))
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return texts.select("same", "text_first", "marks").mapInArrow(run, "same bigint, n_repeated bigint, n_later bigint, spans string, later_spans string")


def _starts(marks: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """Starts of a text's repeated windows, and the earliest document that holds each."""
    at, lists = marks.values.flatten()
    offset, count, first = (v.to_numpy() for v in lists.flatten().flatten())
    sizes = np.diff(lists.offsets.to_numpy())
    base = np.repeat(at.to_numpy(), sizes).astype(np.int64) + offset
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(base, count) + inner, np.repeat(first, count)


def _joined(spans: list[tuple[int, int]]) -> str:
    return ",".join([f"{a}:{b}" for a, b in spans])


def cut(text: str, spans: str) -> str:
    """The text without the words of ``spans`` and the white space after them."""
    raw = text.encode()
    begins = [m.start() for m in _WORDS.finditer(raw)] + [len(raw)]
    out, done = [], 0
    for a, b in (map(int, s.split(":")) for s in spans.split(",") if s):
        out.append(raw[done : begins[a]])
        done = begins[b]
    return b"".join([*out, raw[done:]]).decode()


def drop_later(docs: DataFrame, passage: int = PASSAGE, seed: int = SEED) -> DataFrame:
    """``docs`` without the passages that an earlier document holds; n_chars follows if there is one."""
    schema = docs.schema
    at = schema.fieldNames().index("text")
    found = repeats(docs, passage, seed).where("n_later > 0").select(F.col("text_hash").alias("__same"), _id("doc_id").alias("__id"), F.col("later_spans").alias("__cut")).distinct()
    keyed = docs.withColumn("__same", F.xxhash64("text")).withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)))
    marked = keyed.join(found, ["__same", "__id"], "left").select(*docs.columns, "__cut")

    def run(batches):
        for batch in batches:
            texts = [t if not c else cut(t, c) for t, c in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)]
            columns = [pa.array(texts, batch.schema.field(at).type) if i == at else batch.column(i) for i in range(len(schema))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    out = marked.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
