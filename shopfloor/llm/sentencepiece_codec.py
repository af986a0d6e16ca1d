"""SentencePiece encoding and decoding for merge-type vocabularies.

The encoder is a score-ordered agenda of adjacent symbol pairs: all pairs whose
concatenation is a piece wait in a heap ordered by (score, position), the best
is merged, and the pairs it touches are queued anew.  Symbols that end as no
piece fall back to their bytes.

No piece has the white-space mark after another character (this is verified
when a model is loaded; other models take a whole text as one unit), so no
merge crosses from a word into the next mark and a text can be encoded unit by
unit: a unit is a space with the non-spaces behind it.  Units repeat, so each
worker keeps a bounded table of encoded units.  Every unit that enters it is
checked, one Arrow batch at a time, against the sentencepiece library: its ids
must equal ``encode(unit)`` and its text ``decode(ids)``; a difference stops the
job.

Defined results: a null text is an empty one (no ids, empty text); ids and
other columns may be null; equal rows give equal results, one per row; texts
may be of any length (units over ``LONG_UNIT`` characters are not kept in the
table); an empty table gives an empty result.  Extra columns are carried by
:func:`encode_documents` only if asked for.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, holds, text_parts, trim

MARK = "▁"
LONG_UNIT = 64
KEPT_UNITS = 200_000
_NONE = float("inf")
_RUNS = re.compile(r" +[^ ]*")


class Codec:
    """One vocabulary, its agenda encoder, its decoder and the library check."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.lib = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.pieces: list[bytes] = []
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.unknown = sp.unk_id()
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.pieces.append(bytes([value]))
            elif sp.is_control(i):
                self.pieces.append(b"")
            elif sp.is_unknown(i):
                self.pieces.append(" ⁇ ".encode())
            else:
                self.pieces.append(piece.replace(MARK, " ").encode())
                if not sp.is_unused(i):
                    self.ids[piece] = i
                    self.rank[piece] = -sp.get_score(i)
        self.by_word = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.kept: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def _fallback(self, symbol: str) -> list[int]:
        if symbol in self.ids:
            return [self.ids[symbol]]
        if not self.byte_ids[0]:
            return [self.unknown]
        return [self.byte_ids[b] for b in symbol.encode("utf-8", errors="replace")]

    def merge_short(self, text: str) -> list[str]:
        """As :meth:`merge`, for short units: the agenda is a list beside the symbols.

        ``min`` and ``index`` find the best pair, leftmost on ties, faster than
        a heap does while there are few pairs.
        """
        get, symbols = self.rank.get, list(text)
        agenda = [get(a + b, _NONE) for a, b in zip(text, text[1:])]
        while agenda:
            best = min(agenda)
            if best == _NONE:
                break
            i = agenda.index(best)
            pair = symbols[i] + symbols[i + 1]
            symbols[i : i + 2] = [pair]
            del agenda[i]
            if i:
                agenda[i - 1] = get(symbols[i - 1] + pair, _NONE)
            if i < len(agenda):
                agenda[i] = get(pair + symbols[i + 1], _NONE)
        return symbols

    def merge(self, symbols: list[str]) -> list[str]:
        """Merges adjacent symbols, the best-scored pair first, leftmost on ties."""
        rank = self.rank
        n = len(symbols)
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            r = rank.get(pair)
            if r is not None:
                heap.append((r, i, pair))
        if not heap:
            return symbols
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, pair = pop(heap)
            left = symbols[i]
            if not left:
                continue
            j = after[i]
            if j >= n or len(left) + len(symbols[j]) != len(pair) or not pair.startswith(left):
                continue  # one side has grown or gone since
            symbols[i] = pair
            symbols[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                nxt = pair + symbols[k]
                r = rank.get(nxt)
                if r is not None:
                    push(heap, (r, i, nxt))
            h = before[i]
            if h >= 0:
                nxt = symbols[h] + pair
                r = rank.get(nxt)
                if r is not None:
                    push(heap, (r, h, nxt))
        return [s for s in symbols if s]

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of one unit as the library encodes it alone (with its mark in front)."""
        marked = MARK + (unit.replace(" ", MARK) if " " in unit else unit)
        symbols = self.merge_short(marked) if len(marked) <= LONG_UNIT else self.merge(list(marked))
        ids = [self.ids.get(s, -1) for s in symbols]
        if -1 not in ids:
            return ids
        return [i for s in symbols for i in self._fallback(s)]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, marks as spaces, bytes as UTF-8, without the first mark."""
        data = b"".join([self.pieces[i] for i in ids])
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", errors="replace")

    def learn(self, units: list[str]) -> dict[str, str]:
        """Ids (joined by commas) of new units; ids and decoded text are checked against the library."""
        ids = {u: self.encode_unit(u) for u in units if u}
        ours = list(ids.items())
        for (unit, own), theirs in zip(ours, self.lib.encode([u for u, _ in ours], num_threads=1), strict=True):
            if own != theirs:
                raise RuntimeError(f"agenda and library differ on {unit!r}: {own} and {theirs}")
        for (unit, own), theirs in zip(ours, self.lib.decode([i for _, i in ours], num_threads=1), strict=True):
            text = self.decode(own)
            if text != theirs:
                raise RuntimeError(f"decoder and library differ on {unit!r}: {text!r} and {theirs!r}")
            if text != unit:
                raise RuntimeError(f"{unit!r} decodes to {text!r}")
        found = {u: ",".join(map(str, i)) for u, i in ours}
        if "" in units:  # a space that ends a text: the library encodes no such unit alone
            found[""] = ",".join(map(str, self.encode_unit("")))
        return found

    def units(self, text: str) -> list[str]:
        """The text's units, each without its first space."""
        if not text:
            return []
        if MARK in text:
            text = text.replace(MARK, " ")
        if not self.by_word:
            return [text]
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [u[1:] for u in _RUNS.findall(" " + text)]
        return text.split(" ")

    def encode_batch(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids joined by commas, decoded text) of each text.

        Units stay in two generations of at most KEPT_UNITS each; units in use
        move to the younger one, the older one is dropped when that is full.
        """
        split = [self.units(t) for t in texts]
        needed = {u for units in split for u in units}
        missing = [u for u in needed if u not in self.kept]
        older = self.older
        found = {u: older[u] for u in missing if u in older}
        found.update(self.learn([u for u in missing if u not in found]))
        lasting = {u: i for u, i in found.items() if len(u) <= LONG_UNIT}
        if len(self.kept) + len(lasting) > KEPT_UNITS:
            found.update((u, self.kept[u]) for u in needed if u in self.kept)
            self.older, self.kept = self.kept, {}
        self.kept.update(lasting)
        if all(u in self.kept for u in found) and len(found) < len(needed):
            get = self.kept.__getitem__
        else:
            get = lambda u: found[u] if u in found else self.kept[u]
        # learn() has decoded every unit to exactly itself, so a text's decoded units are its units
        return [(",".join(list(map(get, units))), " ".join(units)) for units in split]


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    return Codec(model)


holds("sentencepiece", codec.cache_clear)


def read_model(path: str) -> bytes:
    """A vocabulary file (a few hundred KB, whatever the corpus size)."""
    with open(path, "rb") as f:
        return f.read()


#: Bounds of what is at hand besides the two tables: bytes of texts read at once, characters encoded at once.
PART_BYTES = 1_000_000
SLICE_CHARS = 500_000


def _slices(texts: list[str | None]) -> Iterator[list[str]]:
    """Consecutive texts of about SLICE_CHARS characters together; nulls as empty."""
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(t or "")
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_documents(docs: DataFrame, model_path: str, keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """Every row's whole text encoded and decoded.

    Returns the ``keep`` columns (default doc_id), n_tokens, ids_sha256 (of the
    decimal ids joined by commas) and decoded_sha256; ``with_ids`` adds the ids
    and the decoded text themselves.  One pass without a shuffle.
    """
    keep = ["doc_id"] if keep is None else keep
    model = read_model(model_path)
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    picked = docs.select(*[F.col(c) for c in keep], F.col("text").alias("__text"))

    def run(batches):
        claim("sentencepiece")
        own = codec(model)
        for batch in (part for whole in batches for part in text_parts(whole, len(keep), PART_BYTES)):
            trim()
            texts = batch.column(len(keep)).to_pylist()
            at = 0
            for part in _slices(texts):
                counts, ids_hash, text_hash, ids, decoded = [], [], [], [], []
                for joined, text in own.encode_batch(part):
                    counts.append(joined.count(",") + 1 if joined else 0)
                    ids_hash.append(hashlib.sha256(joined.encode()).hexdigest())
                    text_hash.append(hashlib.sha256(text.encode()).hexdigest())
                    if with_ids:
                        ids.append(np.array(joined.split(","), dtype=np.int32) if joined else np.zeros(0, np.int32))
                        decoded.append(text)
                columns = [batch.column(i).slice(at, len(part)) for i in range(len(keep))]
                columns += [pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                if with_ids:
                    columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                at += len(part)
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * with_ids])

    return picked.mapInArrow(run, schema)


def decode_ids(df: DataFrame, model_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Adds ``out``: the decoded text of an ``array<int>`` column (null ids: null)."""
    model = read_model(model_path)

    @F.pandas_udf("string")
    def decoded(column):
        own = codec(model)
        return column.map(lambda x: None if x is None else own.decode(list(x)))

    return df.withColumn(out, decoded(F.col(ids)))
