"""Mixing sources to target weights.

Words of a source's documents are packed, one document behind the other, into
blocks of a fixed number of words.  Output shards draw multinomial source
counts; a source's draws, shard behind shard, are its slots; a slot maps to a
block through the source's pseudorandom permutation of block indexes (a new one
for every pass over the source), and slots and blocks are joined by (source,
block).

A source's slots end at its quota, and what the draws leave short of the quota
is dealt to a last shard, so the words taken are within about one block of the
target.  A quota is at most two passes, so no block, and no document, is taken
more than twice.  All draws are seeded: reruns agree.

Scale: a hot source is spread over hash buckets of documents (prefix sums run
over bucket totals first), slots and blocks meet in a plain equi-join on
(source, block) whose keys are all small, and only one row per source (name and
size) reaches the driver.

Defined results: size counts words of the text (null: 0); a null source is a
source of its own, last in order; documents of size 0 take part with nothing
taken; rows with equal ids, and equal rows, are packed separately and each
gets its own row; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, claim, mix64, partitions, pin, prefix_sums, text_parts

# The contract's weights, in turn, and the share of all words to take.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0

BLOCK_WORDS = 32
SHARD_SLOTS = 8192
BUCKET_DOCS = 4096

_WORD = re.compile(WORD.encode())


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Words to take of each source, in order: by weight, at most ``most`` times
    its size, the excess shared anew by weight until nobody is above."""
    caps = [most * s for s in sizes]
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    left, free = share * sum(sizes), list(range(len(sizes)))
    while free:
        unit = left / sum(weight[i] for i in free)
        above = [i for i in free if unit * weight[i] > caps[i]]
        if not above:
            for i in free:
                out[i] = unit * weight[i]
            break
        for i in above:
            out[i] = caps[i]
            left -= caps[i]
        free = [i for i in free if i not in set(above)]
    return out


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: a four-round Feistel network over
    the next even power of two, walked until it lands inside."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    x = index.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        y = x[todo]
        left, right = y >> shift, y & mask
        for r in range(4):
            left, right = right, left ^ (mix64(right, key * 4 + r) & mask)
        x[todo] = (left << shift) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


class Plan:
    """Sizes, targets and quotas: one entry per source."""

    def __init__(self, rows: list[tuple[str | None, int]], weights=WEIGHTS, share=SHARE, most=MOST, block_words=BLOCK_WORDS, shard_slots=SHARD_SLOTS, seed=7):
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or ""))  # Python orders text by code point
        self.names = [r[0] for r in rows]
        self.sizes = [int(r[1]) for r in rows]
        self.targets = targets(self.sizes, weights, share, most)
        self.blocks = [-(-s // block_words) for s in self.sizes]
        self.quotas = [min(int(most * n), round(t * n / s)) if s else 0 for n, t, s in zip(self.blocks, self.targets, self.sizes, strict=True)]
        self.total = sum(self.quotas)
        self.shards = -(-self.total // shard_slots)
        self.shard_slots, self.seed = shard_slots, seed


def with_size(docs: DataFrame) -> DataFrame:
    """Adds ``size``: the number of words of the text (null: 0)."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def packed(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 7) -> tuple[DataFrame, Plan]:
    """``docs`` with size, source number, and the place (``start``) of each
    document in its source's word stream; and the mixing plan."""
    spark = docs.sparkSession
    sized = docs if "size" in docs.columns else with_size(docs)
    stats = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")).collect()  # one row per source
    plan = Plan([(r["source"], r["words"]) for r in stats], weights, share, most, block_words, shard_slots, seed)
    known = spark.createDataFrame(
        [(i, n, s, float(t)) for i, (n, s, t) in enumerate(zip(plan.names, plan.sizes, plan.targets, strict=True))],
        "src int, __name string, source_size long, target double",
    )
    buckets = max(1, -(-sum(r["docs"] for r in stats) // BUCKET_DOCS))
    sized = sized.join(known, F.col("source").eqNullSafe(F.col("__name"))).drop("__name")
    order = F.xxhash64("doc_id", F.lit(seed))
    sized = sized.withColumn("__bucket", F.pmod(order, F.lit(buckets))).withColumn("__order", order)
    placed = prefix_sums(sized, ["src"], "__bucket", ["__order", "doc_id", "size"], "size", "start")
    return placed.drop("__bucket", "__order"), plan


def drawn_slots(spark, plan: Plan) -> DataFrame:
    """(shard, src, slot, block): every output slot and the block it holds."""
    p = np.array(plan.quotas, float)
    names = "shard bigint, src int, first bigint, n bigint"
    if not plan.total:
        return spark.createDataFrame([], "shard bigint, src int, slot bigint, block bigint")
    p /= p.sum()
    shards, per, seed, total = plan.shards, plan.shard_slots, plan.seed, plan.total

    def draw(batches):
        claim("mixing")
        for batch in batches:
            ids = batch.column(0).to_pylist()
            if ids:
                counts = np.stack([np.random.default_rng([seed, k]).multinomial(min(per, total - k * per), p) for k in ids])
                rows, src = np.nonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(ids)[rows]), pa.array(src.astype(np.int32)), pa.array(counts[rows, src])], names=["shard", "src", "n"])

    counts = spark.range(shards).mapInArrow(draw, "shard bigint, src int, n bigint")
    counts = prefix_sums(counts.withColumn("__bucket", F.expr("shard div 1024")), ["src"], "__bucket", ["shard"], "n", "first").select("shard", "src", "first", "n")
    drawn = counts.groupBy("src").agg(F.sum("n").alias("drawn"))
    quota = spark.createDataFrame([(i, int(q)) for i, q in enumerate(plan.quotas)], "src int, quota long")
    short = quota.join(drawn, "src", "left").select(
        F.lit(shards).cast("long").alias("shard"), "src", F.coalesce("drawn", F.lit(0)).alias("first"), (F.col("quota") - F.coalesce("drawn", F.lit(0))).alias("n")
    )
    runs = counts.unionByName(short).join(quota, "src").select("shard", "src", "first", F.least("n", F.col("quota") - F.col("first")).alias("n")).where("n > 0")
    blocks = list(plan.blocks)

    def place(batches):
        for batch in batches:
            for shard, src, first, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for lo in range(first, first + n, 65536):
                    slot = np.arange(lo, min(first + n, lo + 65536))
                    block = np.empty(len(slot), np.int64)
                    turn = slot // blocks[src]
                    for t in np.unique(turn):
                        here = turn == t
                        block[here] = permuted(slot[here] % blocks[src], blocks[src], (seed * 1_000_003 + src) * 64 + int(t))
                    k = len(slot)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(k, shard)), pa.array(np.full(k, src, np.int32)), pa.array(slot), pa.array(block)], names=["shard", "src", "slot", "block"])

    # few short rows become many slots: dealt to all tasks before that
    runs = runs.select(*[c.split()[0] for c in names.split(", ")])
    return runs.repartition(partitions(runs), "shard", "src").mapInArrow(place, "shard bigint, src int, slot bigint, block bigint")


def segments(placed: DataFrame, keys: list[str], block_words: int = BLOCK_WORDS) -> DataFrame:
    """(keys, src, block, from_word, words): the part of each document in each block."""
    n = F.lit(block_words)
    rows = placed.select(*keys, "src", "start", "size", F.explode(F.expr(f"sequence(start div {block_words}, (start + greatest(size, 1) - 1) div {block_words})")).alias("block"))
    begin, end = F.greatest("start", F.col("block") * n), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * n)
    return rows.select(*[k for k in dict.fromkeys([*keys, "src", "start", "size"])], "block", (begin - F.col("start")).alias("from_word"), (end - begin).alias("words"))


def mixed_blocks(docs: DataFrame, keys: list[str] | None = None, **options) -> DataFrame:
    """The mix itself: (shard, src, slot, block, keys, from_word, words) for every
    stretch of a document in every slot."""
    keys = ["doc_id"] if keys is None else keys
    inner = [f"__key{i}" for i in range(len(keys))]  # a key may be named as an internal column
    placed, plan = packed(docs.select("doc_id", "text", "source", *[F.col(k).alias(i) for k, i in zip(keys, inner, strict=True)]), **options)
    parts = segments(placed, inner, options.get("block_words", BLOCK_WORDS)).where("words > 0")
    found = drawn_slots(docs.sparkSession, plan).join(parts, ["src", "block"])
    rest = [c for c in found.columns if c not in inner and c not in keys]
    return found.select(*rest, *[F.col(i).alias(k) for k, i in zip(keys, inner, strict=True)])


def taken_counts(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    block_words = options.get("block_words", BLOCK_WORDS)
    # ids and sizes only, read three times below: counted once
    slim = pin(with_size(docs.select("doc_id", "text", "source")).select("doc_id", "source", "size"), "mix-sizes")
    placed, plan = packed(slim, **options)
    placed = placed.select("doc_id", "src", "size", "source_size", "target", "start")
    times = drawn_slots(docs.sparkSession, plan).groupBy("src", "block").agg(F.count(F.lit(1)).alias("times"))
    keys = ["doc_id", "src", "size", "start", "source_size", "target"]
    # rows of size 0 share places; a row number would be needed to tell equal ones apart, so they skip the join
    filled = segments(placed.where("size > 0"), keys, block_words).join(times, ["src", "block"], "left")
    counted = filled.groupBy(*keys).agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return counted.select(*columns).unionByName(placed.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*columns))


def cut_out(text: bytes, parts: list[tuple[int, int, int]]) -> bytes:
    """The words of ``parts`` (from_word, words, times), second takings behind the first.

    Words that stay neighbours keep the white space between them, the text's ends
    that before its first and behind its last word; elsewhere one space joins."""
    ends = [m.span() for m in _WORD.finditer(text)]
    out: list[bytes] = []
    for k in range(max(t for _, _, t in parts)):
        runs: list[list[int]] = []
        for first, n, times in parts:
            if times <= k:
                continue
            if runs and runs[-1][1] == first:
                runs[-1][1] = first + n
            else:
                runs.append([first, first + n])
        for first, end in runs:
            piece = text[ends[first][0] if first else 0 : ends[end - 1][1] if end < len(ends) else len(text)]
            if out and not out[-1][-1:].isspace() and not piece[:1].isspace():
                out.append(b" ")
            out.append(piece)
    return b"".join(out)


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as mixed: each document's text becomes the words the mix takes of
    it (second takings behind the first ones), with the white space between words
    that stay neighbours; documents of which nothing is taken go.  Columns stay; n_chars follows if there is one."""
    block_words = options.get("block_words", BLOCK_WORDS)
    schema, names, at = docs.schema, docs.columns, docs.columns.index("text")
    # the other columns under names that no internal column has
    inner = [c if c in ("doc_id", "text", "source") else f"__col{i}" for i, c in enumerate(names)]
    whole = with_size(docs.toDF(*inner))
    # places are found without the texts, which are shuffled once, to the parts taken of them
    placed, plan = packed(pin(whole.select("doc_id", "source", "size"), "mix-places"), **options)
    times = drawn_slots(docs.sparkSession, plan).groupBy("src", "block").agg(F.count(F.lit(1)).cast("int").alias("times"))
    parts = segments(placed.where("size > 0").select("src", "start", "size"), [], block_words).join(times, ["src", "block"])
    # a document's blocks: one entry per block_words words, never more than its text holds
    taken = parts.groupBy("src", "start").agg(F.sort_array(F.collect_list(F.struct("from_word", "words", "times"))).alias("__parts"))
    places = placed.where("size > 0").join(taken, ["src", "start"], "left").select("doc_id", "source", "size", F.lit(0).alias("__kind"), "start", "__parts")
    rows = places.unionByName(whole.where("size > 0").withColumn("__kind", F.lit(1)), allowMissingColumns=True)
    # rows of equal id, source and size have as many places; each text follows a place of its own
    key = ["doc_id", "source", "size"]
    rows = rows.repartition(partitions(docs), *key)
    rows = rows.withColumn("__k", F.row_number().over(Window.partitionBy(*key, "__kind").orderBy("start", "text")))
    rows = rows.withColumn("__parts", F.lag("__parts").over(Window.partitionBy(*key).orderBy("__k", "__kind")))
    with_parts = rows.where("__kind = 1 and __parts is not null").select(*inner, "__parts")

    def rebuild(batches):
        claim("mixing")
        for batch in (part for whole in batches for part in text_parts(whole, at)):
            lists = batch.column(len(names))
            edge = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            first, n, times = (np.asarray(c) for c in lists.flatten().flatten())  # in the order of the struct's fields
            texts = []
            for text, a, b in zip(batch.column(at), edge[:-1], edge[1:], strict=True):
                parts = list(zip(first[a:b].tolist(), n[a:b].tolist(), times[a:b].tolist(), strict=True))
                texts.append(cut_out(text.as_buffer().to_pybytes(), parts).decode())
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))], names=names)

    out = with_parts.mapInArrow(rebuild, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in names else out
