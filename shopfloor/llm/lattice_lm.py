"""Language-model scoring with a subword lattice.

The probability of a word is the sum over all its segmentations into pieces of
an existing vocabulary of the product of the pieces' unigram probabilities; a
forward recursion in log space over the lattice of pieces gives that marginal.
A text is its words and one end, so its log probability is the sum of theirs:
no piece of the vocabulary reaches over a word's edge, hence the lattice of a
text falls apart into the lattices of its words.

Piece probabilities start from the vocabulary's own scores (for a merge-type
vocabulary, whose scores are ranks, by the rank-frequency rule 1 / (rank + 3)).
With these weights every training word is segmented in all ways, expected piece
counts are gathered (forward-backward, weighted by the word's count), and the
normalised counts, with ``SMOOTH`` added to each piece, are the model.
Characters outside the vocabulary cost their bytes.

Beside it stands the base model, add-one unigrams over words and end.

At scale: a block (a bounded run of documents) numbers its distinct words, so texts
become word numbers and are not moved again.  The (word, block) rows are exchanged
once, by word, where their counts are summed over a window that spills; a word has
at most one row a block.  Each word is then scored once, and its value goes to its
blocks, packed with others, to meet the documents there.  Nothing that grows with
the corpus reaches the driver: it sees three totals and one float per piece.

Defined results: a null text is an empty one (its only token is the end); rows
with a null doc_id count as training rows; repeated rows count as often as they
stand; texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, mix64, pin
from .sentencepiece_codec import MARK, codec

#: Added to every piece's expected count.
SMOOTH = 0.1
#: Columns of a lattice held at once; a longer word's recursions carry the last columns over to its next slice.
SLICE = 256
#: Characters of the words that are scored together, unless one word has more.
CHUNK_CHARS = 4_000_000
#: Text bytes of a block, on average; one document is never split.
BLOCK_BYTES = 8_000_000
#: Rows that are scored together, and rows whose values are packed together.
ROWS = 50_000
PACK_ROWS = 1_000_000
LN10 = math.log(10.0)


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a text's UTF-8 bytes with A-Z lowered (white space: the six ASCII characters)."""
    return (text or b"").lower().split()


_HASH = np.uint64(1_000_003)
_PAD = np.uint32(0xFFFFFFFF)  # no character
_FILTER_BITS = 21


class Lattice:
    """Pieces with log probabilities; forward and backward recursions over many words at once."""

    def __init__(self, pieces: list[str], logs: np.ndarray, byte_log: float, end: float = 0.0):
        self.pieces, self.logs, self.byte_log, self.end = pieces, np.append(logs, -np.inf), byte_log, end
        keys = np.array([self._key(p) for p in pieces], np.uint64)
        order = np.argsort(keys)
        self.keys, self.number = keys[order], order.astype(np.int32)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.keys & np.uint64((1 << _FILTER_BITS) - 1)] = True
        self.widest = max(map(len, pieces), default=1)

    @staticmethod
    def _key(piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * _HASH + np.uint64(ord(c) + 1)
        return int(mix64(h, len(piece))[0])

    def _find(self, h: np.ndarray, n: int) -> np.ndarray:
        """Piece numbers of rolling hashes of n characters; len(pieces) where there is none."""
        keys = mix64(h, n)
        out = np.full(h.shape, len(self.pieces), np.int32)
        at = np.nonzero(self.maybe[keys & np.uint64((1 << _FILTER_BITS) - 1)])
        if len(at[0]):
            k = keys[at]
            i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
            out[at] = np.where(self.keys[i] == k, self.number[i], len(self.pieces))
        return out

    def _chunks(self, words: list[str]):
        """(owner, length, marked words) by length, in bounded chunks; long words share
        a chunk with words of at least half their length."""
        marked = [MARK + w for w in words]
        size = np.array([len(m) for m in marked], np.int64)
        order = np.argsort(size, kind="stable")
        i = 0
        while i < len(order):
            longest = int(size[order[min(i + 4000, len(order) - 1)]])
            take = order[i : i + max(1, min(150_000 // min(longest, SLICE), CHUNK_CHARS // longest))]
            take = take[size[take] <= max(SLICE, 2 * int(size[take[0]]))]
            yield take, size[take], [marked[k] for k in take]
            i += len(take)

    @staticmethod
    def _window(marked: list[str], size: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Code points of columns start to stop of the words, padded."""
        width = stop - start
        text = np.array([m[start:stop] for m in marked], dtype=f"<U{width}").view(np.uint32).reshape(len(marked), width).copy()
        text[np.arange(start, stop)[None, :] >= size[:, None]] = _PAD
        return text

    def _slices(self, width: int) -> list[tuple[int, int, int]]:
        """(first, end, back): each slice's columns, and how many before it a piece that ends in it may start."""
        return [(lo, min(lo + SLICE, width), min(lo, self.widest - 1)) for lo in range(0, width, SLICE)]

    def _edges(self, text: np.ndarray):
        """Per piece length n: (piece numbers, log probabilities) at every start."""
        width = text.shape[1]
        points = text.astype(np.uint64) + np.uint64(1)
        h = np.zeros(text.shape, np.uint64)
        out = []
        with np.errstate(over="ignore"):
            for n in range(1, min(self.widest, width) + 1):
                h = h[:, : width - n + 1] * _HASH + points[:, n - 1 :]
                number = self._find(h, n)
                out.append((number, self.logs[number]))
        number, logs = out[0]
        lone = (number == len(self.pieces)) & (text != _PAD)
        if lone.any():
            size = 1 + (text[lone] >= 0x80).astype(int) + (text[lone] >= 0x800) + (text[lone] >= 0x10000)
            logs[lone] = self.byte_log * size
        return out

    @staticmethod
    def _sum(t: np.ndarray) -> np.ndarray:
        top = t.max(axis=0)
        base = np.where(np.isfinite(top), top, 0.0)
        with np.errstate(divide="ignore"):
            return base + np.log(np.exp(t - base).sum(axis=0))

    def _forward(self, edges, known: np.ndarray, width: int) -> np.ndarray:
        """The columns (one row each) up to ``width`` behind the ``known`` ones."""
        ending = np.full((width + 1, len(edges), known.shape[1]), -np.inf)
        for n, (_, logs) in enumerate(edges[:width], 1):
            ending[n:, n - 1] = logs[:, : width - n + 1].T
        alpha = np.full((width + 1, known.shape[1]), -np.inf)
        alpha[: len(known)] = known
        for j in range(len(known), width + 1):
            k = min(j, len(edges))
            alpha[j] = self._sum(ending[j, :k] + alpha[j - k : j][::-1])
        return alpha

    def _walk(self, size: np.ndarray, marked: list[str]):
        """Per slice (first, end, back, known columns, window, edges, alpha), from left to right."""
        known = np.zeros((1, len(size)))
        for lo, hi, back in self._slices(int(size.max())):
            text = self._window(marked, size, lo - back, hi)
            edges = self._edges(text)
            alpha = self._forward(edges, known, text.shape[1])
            yield lo, hi, back, known, text, edges, alpha
            known = alpha[-min(hi + 1, self.widest) :]

    @staticmethod
    def _at_end(total: np.ndarray, size: np.ndarray, lo: int, hi: int, back: int, alpha: np.ndarray) -> None:
        here = np.flatnonzero((size > lo) & (size <= hi))
        total[here] = alpha[size[here] - lo + back, here]

    def scores(self, words: list[str]) -> np.ndarray:
        """Marginal log probability (natural) of each word, over all segmentations."""
        out = np.zeros(len(words))
        for owner, size, marked in self._chunks(words):
            total = np.zeros(len(size))
            for lo, hi, back, _, _, _, alpha in self._walk(size, marked):
                self._at_end(total, size, lo, hi, back, alpha)
            out[owner] = total
        return out

    def expect(self, words: list[str], weights: np.ndarray) -> tuple[np.ndarray, float]:
        """Expected counts of all pieces, and of single bytes, over the words' lattices.

        Of a long word only the carried columns of each slice are kept on the way
        forward; on the way back each slice's own columns are computed again."""
        counts, in_bytes = np.zeros(len(self.pieces) + 1), 0.0
        for owner, size, marked in self._chunks(words):
            rows, width = len(size), int(size.max())
            total, slices = np.zeros(rows), []
            for lo, hi, back, known, text, edges, alpha in self._walk(size, marked):
                self._at_end(total, size, lo, hi, back, alpha)
                slices.append((lo, hi, back, known.copy()))
            # the last slice's window, edges and columns are still at hand
            after = np.where(size == width, 0.0, -np.inf)[None, :]  # columns from the slice's end on
            for lo, hi, back, known in reversed(slices):
                ahead = min(self.widest - 1, width - hi)
                if hi < width:
                    text = self._window(marked, size, lo - back, hi + ahead)
                    edges = self._edges(text)
                    alpha = self._forward(edges, known, back + hi - lo)
                own = hi - lo
                starting = np.full((own, len(edges), rows), -np.inf)
                for n, (_, logs) in enumerate(edges, 1):
                    some = logs[:, back : back + own].T
                    starting[: len(some), n - 1] = some
                beta = np.full((own + ahead + 1, rows), -np.inf)
                beta[own:] = after[: ahead + 1]
                for i in range(own - 1, -1, -1):
                    k = min(own + ahead - i, len(edges))
                    inner = self._sum(starting[i, :k] + beta[i + 1 : i + 1 + k])
                    beta[i] = np.where(lo + i < size, inner, np.where(lo + i == size, 0.0, -np.inf))
                after = beta
                for n, (number, logs) in enumerate(edges, 1):
                    starts = min(own, own + ahead - n + 1)
                    if starts <= 0:
                        break
                    share = alpha[back : back + starts].T + logs[:, back : back + starts] + beta[n : n + starts].T
                    at = np.nonzero(np.isfinite(share))
                    p = np.exp(share[at] - total[at[0]]) * weights[owner[at[0]]]
                    which = number[:, back : back + starts][at]
                    counts += np.bincount(which, weights=p, minlength=len(counts))
                    if n == 1 and (lone := which == len(self.pieces)).any():
                        c = text[:, back : back + starts][at][lone]
                        in_bytes += float((p[lone] * (1 + (c >= 0x80).astype(int) + (c >= 0x800) + (c >= 0x10000))).sum())
        return counts[:-1], in_bytes


@lru_cache(maxsize=2)
def existing(model: bytes) -> Lattice:
    """The vocabulary with its own scores: log probabilities as they are, ranks by 1 / (rank + 3)."""
    own = codec(model)
    pieces = list(own.ids)
    costs = np.array([own.rank[p] for p in pieces])
    if len(costs) and costs.max() > 1000:  # ranks, not log probabilities
        costs = np.log(np.unique(costs, return_inverse=True)[1] + 3.0)
    norm = math.log(np.exp(-costs).sum() + 1.0)
    return Lattice(pieces, -costs - norm, -norm - math.log(256.0))


def _pack(values: np.ndarray) -> bytes:
    """An array as its byte planes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return planes.reshape(width, len(planes) // width).T.copy().view(kind).ravel()


def numbered(docs: DataFrame, train: F.Column) -> DataFrame:
    """(block, doc_id, train, numbers, words, counts): blocks of about BLOCK_BYTES of neighbouring rows of a task.

    A row per document holds its tokens as numbers of the block's words; a row per
    block (numbers null) holds these words in order and their counts in training rows."""
    rows = docs.select("doc_id", F.coalesce(train, F.lit(True)).alias("train"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))
    kind = dict(docs.dtypes)["doc_id"]

    def number(batches):
        from pyspark import TaskContext

        block, held, index, learnt, id_type = TaskContext.get().partitionId() << 32, 0, defaultdict(), [], None
        index.default_factory = index.__len__
        names = ["block", "doc_id", "train", "numbers", "words", "counts"]

        def words():
            counts = np.bincount(np.concatenate([*learnt, np.zeros(0, np.uint32)]), minlength=len(index))
            columns = [pa.array([block], pa.int64()), pa.nulls(1, id_type), pa.nulls(1, pa.bool_()), pa.nulls(1, pa.binary())]
            return pa.RecordBatch.from_arrays([*columns, pa.array([zstandard.compress(b"\n".join(index), 1)], pa.binary()), pa.array([_pack(counts)], pa.binary())], names=names)

        for batch in batches:
            blocks, numbers, done, id_type = [], [], [], batch.column(0).type
            for train, data in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if held >= BLOCK_BYTES:
                    if index:
                        done.append(words())
                    block, held, learnt = block + 1, 0, []
                    index.clear()
                found = tokens(data.as_py())
                own = np.fromiter(map(index.__getitem__, found), np.uint32, len(found))
                if train:
                    learnt.append(own)
                held += len(data.as_buffer()) + 64
                blocks.append(block)
                numbers.append(_pack(own))
            nothing = pa.nulls(len(blocks), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), batch.column(0), batch.column(1), pa.array(numbers, pa.binary()), nothing, nothing], names=names)
            yield from done
        if index:
            yield words()

    return rows.mapInArrow(number, f"block bigint, doc_id {kind}, train boolean, numbers binary, words binary, counts binary")


def block_words(blocks: DataFrame) -> DataFrame:
    """(word, block, number, c): the distinct words of every block."""

    def spread(batches):
        for batch in batches:
            for block, packed, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words, c = zstandard.decompress(packed).split(b"\n"), _unpack(counts, np.int64)
                for i in range(0, len(words), ROWS):
                    part = words[i : i + ROWS]
                    columns = [pa.array(part, pa.binary()), pa.array(np.full(len(part), block, np.int64)), pa.array(np.arange(i, i + len(part), dtype=np.int32)), pa.array(c[i : i + ROWS])]
                    yield pa.RecordBatch.from_arrays(columns, names=["word", "block", "number", "c"])

    return blocks.where("words is not null").select("block", "words", "counts").mapInArrow(spread, "word binary, block bigint, number int, c bigint")


def _joined(batches, rows: int):
    """Batches put together to about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _text(word: bytes) -> str:
    return word.decode("utf-8", errors="replace")


def fit(counts: DataFrame, ends: int, model: bytes) -> Lattice:
    """Piece probabilities from expected counts over the lattices of the training words (word, c)."""

    def expect(batches):
        lattice = existing(model)
        counts, in_bytes = np.zeros(len(lattice.pieces)), 0.0
        for part in _joined(batches, ROWS):
            n, b = lattice.expect([_text(w) for w in part.column(0).to_pylist()], part.column(1).to_numpy().astype(float))
            counts += n
            in_bytes += b
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([*some.tolist(), -1], pa.int32()), pa.array([*counts[some].tolist(), in_bytes], pa.float64())], names=["piece", "n"])

    # one row per piece of the vocabulary at most
    gathered = counts.select("word", "c").mapInArrow(expect, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    n = {r["piece"]: r["n"] for r in gathered}
    own = existing(model)
    each = np.array([n.get(i, 0.0) for i in range(len(own.pieces))]) + SMOOTH
    in_bytes, ended = n.get(-1, 0.0) + 256 * SMOOTH, ends + SMOOTH
    total = each.sum() + in_bytes + ended
    return Lattice(own.pieces, np.log(each / total), math.log(in_bytes / 256 / total), math.log(ended / total))


def score_documents(docs: DataFrame, train: F.Column, model: bytes) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` is the boolean column that says which rows to learn from (null: learn)."""
    spark = docs.sparkSession
    blocks = pin(numbered(docs, train), "lm-blocks")
    # one exchange: the window's sum and the first of a word's rows need no second one
    whole = Window.partitionBy("word")
    first = (F.col("block") == F.min("block").over(whole)).alias("first")
    placed = pin(block_words(blocks).select("word", "block", "number", F.sum("c").over(whole).alias("c"), first), "lm-words")
    learn = placed.where("first and c > 0")
    totals = learn.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = blocks.where("numbers is not null and train").count()
    n, v = (totals["n"] or 0) + ends, totals["v"] + (ends > 0)
    learnt = spark.sparkContext.broadcast(fit(learn, ends, model))  # one float per piece
    unit = math.log10(n + v + 1)

    def weigh(batches):
        """Scores each word once, as its rows are neighbours, and packs what goes to a block."""
        last, value = None, 0.0
        held, size = [], 0

        def out():
            block, number, c, lp = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((number, block))
            block, number, c, lp = block[order], number[order], c[order], lp[order]
            edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            parts = [pa.array([_pack(x[i:j]) for i, j in zip(edge[:-1], edge[1:], strict=True)], pa.binary()) for x in (number, c, lp)]
            return pa.RecordBatch.from_arrays([pa.array(block[edge[:-1]]), *parts], names=["block", "number", "c", "lp"])

        for part in _joined(batches, ROWS):
            word = part.column(0).combine_chunks()
            starts = np.r_[True, pa.compute.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)]
            if word[0].as_py() == last:
                starts[0] = False
            new = word.filter(pa.array(starts)).to_pylist()
            values = np.r_[value, learnt.value.scores([_text(w) for w in new]) / LN10]
            lp = values[np.cumsum(starts)]
            last, value = word[-1].as_py(), float(lp[-1])
            held.append((*[part.column(k).to_numpy() for k in (1, 2, 3)], lp))
            size += len(lp)
            if size >= PACK_ROWS:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    packed = placed.select("word", "block", "number", "c").mapInArrow(weigh, "block bigint, number binary, c binary, lp binary")
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def judge(left, right):
        number, c, lp = (np.concatenate([np.zeros(0, t), *[_unpack(x, t) for x in right.column(k).to_pylist()]]) for k, t in (("number", np.int32), ("c", np.int64), ("lp", np.float64)))
        base, score, known = np.zeros(len(number)), np.zeros(len(number)), np.zeros(len(number), bool)
        base[number], score[number], known[number] = np.log10(c + 1.0) - unit, lp, c > 0
        end = (math.log10(ends + 1) - unit, learnt.value.end / LN10, ends > 0)
        rows = []
        for data in left.column("numbers").to_pylist():
            own = _unpack(data, np.uint32)
            rows.append((len(own) + 1, int(known[own].sum()) + end[2], n, math.fsum([*base[own].tolist(), end[0]]), math.fsum([*score[own].tolist(), end[1]])))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.table(
            [left.column("doc_id"), pa.compute.invert(left.column("train")), *[pa.array(columns[i], pa.int64() if i < 3 else pa.float64()) for i in range(5)]],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    texts = blocks.where("numbers is not null").select("block", "doc_id", "train", "numbers")
    return texts.groupBy("block").cogroup(packed.groupBy("block")).applyInArrow(judge, schema)


def learning_rule(modulus: int = 7, held_out: int = 2) -> F.Column:
    """The rows to learn from: crc32 of the id as text has another remainder."""
    return crc_mod("doc_id", modulus) != held_out
