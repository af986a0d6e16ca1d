"""Fill-in-the-middle texts by rotating blocks in place.

A text is cut into tokens (white space and the word after it; white space at the
end is one of its own).  Two draws, seeded by the document's id, cut it into
prefix, middle and suffix.  The bytes go into one ``bytearray``; a sentinel is
inserted before each segment, and neighbouring segments are exchanged by three
reversals of slices.  A sentinel holds one ``<``, at its front, and one ``>``, at
its end, so none can arise across a border: in the result each of the three is
found exactly once, and the inverse rotation gives the text back, byte by byte.

Forms: ``psm`` is prefix, suffix, middle; ``spm`` suffix, prefix, middle;
``plain`` is the text as it was.

Defined results: a null text is the empty one; empty texts and texts that hold a
sentinel stay plain; a document with a null id draws as if its id were the empty
string; rows of one id and text give equal results.  Texts are read whole, one
document at a time.  Only the id, the text and the columns in ``keep`` are read, and
an output column takes the place of none: a clash with ``keep`` raises.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SEED = 42
#: Of 100: texts that change form, and those among them whose suffix comes first.
CHANGED, SUFFIX_FIRST = 50, 80
#: Fixed values of the format, before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")

_OUT = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def token_ends(raw: bytes) -> np.ndarray:
    """Byte offsets at which the tokens of a text end."""
    if not raw:
        return np.zeros(0, np.int64)
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    return np.append(np.flatnonzero(~space[:-1] & space[1:]) + 1, len(raw))


def draws(seed: int, doc_id) -> list[int]:
    """Four unsigned numbers of 32 bits for a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _reverse(buffer: bytearray, start: int, end: int) -> None:
    view = np.frombuffer(buffer, np.uint8)[start:end]
    half = len(view) // 2
    left, right = view[:half], view[len(view) - half :]
    held = left.copy()
    left[:] = right[::-1]
    right[:] = held[::-1]


def exchange(buffer: bytearray, start: int, border: int, end: int) -> None:
    """Swaps the neighbouring blocks [start, border) and [border, end) in place."""
    _reverse(buffer, start, border)
    _reverse(buffer, border, end)
    _reverse(buffer, start, end)


def rearrange(raw: bytes, prefix_end: int, middle_end: int, form: str, sentinels: Sequence[bytes]) -> bytearray:
    """Sentinels before the three segments, then one exchange of blocks."""
    p, s, m = sentinels
    buffer = bytearray(raw)
    for at, mark in ((middle_end, s), (prefix_end, m), (0, p)):  # from the right: offsets further left still hold
        buffer[at:at] = mark
    middle = len(p) + prefix_end
    suffix = middle + len(m) + middle_end - prefix_end
    exchange(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def undo(output: bytes, form: str, sentinels: Sequence[bytes]) -> bytes:
    """The text that ``rearrange`` was given, from its result and form alone."""
    if form == "plain":
        return output
    p, s, m = sentinels
    buffer = bytearray(output)
    moved = output.index(m) if form == "psm" else output.index(p)
    back = output.index(s)  # the suffix block begins here and ends at ``moved``
    exchange(buffer, back, moved, len(buffer))
    for mark in (s, m, p):
        at = buffer.rindex(mark)
        del buffer[at : at + len(mark)]
    return bytes(buffer)


def _chars(raw: bytes) -> int:
    """Code points: the bytes that do not continue one."""
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def transformed(raw: bytes, doc_id, seed: int, changed: int, suffix_first: int, sentinels: Sequence[bytes]) -> tuple:
    """(tokens, form, prefix and middle in code points or None, output) of one text."""
    ends = token_ends(raw)
    n = len(ends)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not n or h3 % 100 >= changed or any(mark in raw for mark in sentinels):
        return n, "plain", None, None, raw
    form = "spm" if h4 % 100 < suffix_first else "psm"
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    return n, form, _chars(raw[:first]), _chars(raw[first:second]), bytes(rearrange(raw, first, second, form, sentinels))


def _checked(sentinels: Sequence[str]) -> list[bytes]:
    marks = [s.encode() for s in sentinels]
    if len(set(marks)) != 3 or not all(re.fullmatch(rb"<[^<>]+>", m) for m in marks):
        raise ValueError("three different sentinels, each <...> without a further bracket")
    return marks


def transform(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    seed: int = SEED,
    changed: int = CHANGED,
    suffix_first: int = SUFFIX_FIRST,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """``keep`` and, per document, its tokens, form, lengths of prefix and middle, and output."""
    marks = _checked(sentinels)
    if clash := set(keep) & set(_OUT):
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    rows = docs.select("doc_id", "text", *[docs[c].alias(f"__{i}") for i, c in enumerate(keep)])
    kinds = [*(docs.schema[c].dataType.simpleString() for c in keep), "bigint", "string", "bigint", "bigint", "string"]
    names = [*keep, *_OUT]

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                texts = part.column(1).cast(pa.binary())
                made = [transformed(t.as_py() or b"", i, seed, changed, suffix_first, marks) for i, t in zip(part.column(0).to_pylist(), texts, strict=True)]
                columns = [pa.array([r[k] for r in made], kind) for k, kind in enumerate([*list(_OUT.values())[:-1], pa.binary()])]
                yield pa.RecordBatch.from_arrays([*part.columns[2:], *columns[:-1], columns[-1].cast(pa.string())], names=names)

    return rows.mapInArrow(run, ", ".join(f"`{c}` {k}" for c, k in zip(names, kinds, strict=True)))


def restore(found: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Adds ``restored``, the text rebuilt from ``output`` and ``form`` alone."""
    marks = _checked(sentinels)
    at, form = found.columns.index("output"), found.columns.index("form")

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                outputs = part.column(at).cast(pa.binary())
                texts = [undo(o.as_py(), f.as_py(), marks) for o, f in zip(outputs, part.column(form), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*part.schema.names, "restored"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return found.mapInArrow(run, f"{schema}, restored string")
