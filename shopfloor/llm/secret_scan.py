"""Secret scans by assignment-aware lexing.

Two layers find spans in a text (offsets in code points, end exclusive):

* fixed formats: ``assign``, ``access`` and ``hex`` patterns, leftmost and
  non-overlapping per kind; a match that is too short is dropped but stays
  consumed;
* the lexer: around every ``=``, ``:=``, ``=>`` and ``:`` it reads the target
  name to the left and the literal expression to the right (quoted strings with
  escapes, bare configuration values, names, ``+`` concatenations), keeps what
  names stand for while it walks the text, and scores each literal by the
  sensitivity of the target's name and the look of the value.  A literal given
  to a sensitive name is a ``literal`` span; one that reaches a sensitive name
  through a constant is a ``propagated`` span where the literal stands.

Defined results: a null text is an empty one (no spans); nulls in other columns
pass through; equal rows give equal results; texts of any length are read whole
(state is one dictionary of the text's own constants); an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, text_parts

KINDS = ("assign", "access", "hex", "literal", "propagated")

# The base formats.
_ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18

# How much a part of a target's name says about its value.
_NAME_WEIGHT = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.8, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "private": 0.5, "access": 0.4, "api": 0.4, "auth": 0.5, "bearer": 0.7,
    "signing": 0.4, "encryption": 0.4, "client": 0.2, "key": 0.5, "salt": 0.5, "dsn": 0.4,
}
# Parts that say the value only describes a secret.
_NAME_LESS = {"name", "length", "len", "type", "file", "path", "url", "count", "id", "hint", "policy", "field", "label", "prompt", "expires", "ttl", "size"}
_PLACEHOLDER = re.compile(r"(?i)^(?:change_?me|example.*|your[-_ ].*|x{4,}|\*{3,}|\.{3,}|none|null|true|false|todo|placeholder|dummy.*|<.*>|\$\{.*\}|%\(.*\)s|\{\{.*\}\})$")

THRESHOLD = 0.6
MIN_LITERAL = 8
#: Characters of a name, and those it may begin with.
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
_NAME_FIRST = _NAME_CHARS - frozenset("0123456789.-")
_BLANK = frozenset(" \t")

_OPERATOR = re.compile(r":=|=>|[:=]")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]*")
_ATOM = re.compile(r"[ \t]*(?:([rbuf]{0,2})\"((?:[^\"\\\n]|\\.)*)\"|([rbuf]{0,2})'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`|([A-Za-z_][A-Za-z0-9_.]*)(?=[ \t]*(?:[+;,)\]}#\n]|\Z))|([^\s\"'`,;#+(){}\[\]]+))")
_PLUS = re.compile(r"[ \t]*\+")
_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: Without one of these a text has no sensitive name.
_HINT = re.compile("|".join(_NAME_WEIGHT), re.IGNORECASE)
#: Characters kept of either end of a long value; longer than any placeholder's fixed part.
_ENDS = 32


def name_score(name: str) -> float:
    """0 to 1: how likely a target of this name holds a secret."""
    parts = [p.lower() for p in _CAMEL.findall(name)]
    if not parts:
        return 0.0
    score = 1.0
    for p in parts:
        score *= 1.0 - _NAME_WEIGHT.get(p, 0.0)
    score = 1.0 - score
    return score * 0.3 if parts[-1] in _NAME_LESS else score


class _Value:
    """What a name stands for: spans of the text and references to earlier values.

    Values are never copied, so neither chains of constants nor a constant that
    is joined with itself again and again grow beyond the text."""

    __slots__ = ("parts", "look")

    def __init__(self, parts: list):
        self.parts, self.look = parts, None


def _joined_look(looks: list[tuple[int, Counter, str, str]]) -> tuple[int, Counter, str, str]:
    """(length, characters by first place, head, tail) of values joined."""
    n, counts, head, tail = 0, Counter(), "", ""
    for m, c, h, t in looks:
        n += m
        counts.update(c)
        head = (head + h)[:_ENDS] if len(head) < _ENDS else head
        tail = (tail + t)[-_ENDS:]
    return n, counts, head, tail


def _look(text: str, value: _Value) -> tuple[int, Counter, str, str]:
    todo = [value]
    while todo:
        v = todo[-1]
        missing = [p for p in v.parts if isinstance(p, _Value) and p.look is None]
        if v.look is None and missing:
            todo += missing
            continue
        if v.look is None:
            literals = [p if isinstance(p, _Value) else text[p[0] : p[1]] for p in v.parts]
            v.look = _joined_look([p.look if isinstance(p, _Value) else (len(p), Counter(p), p[:_ENDS], p[-_ENDS:]) for p in literals])
        todo.pop()
    return value.look


def _look_score(n: int, counts: Counter, head: str, tail: str) -> float:
    # of a long value, the ends and one of each character decide whether a placeholder's pattern fits
    shown = head + "".join(counts) + tail if n > 2 * _ENDS else head + tail[max(0, len(head) + len(tail) - n) :]
    if n < MIN_LITERAL or _PLACEHOLDER.match(shown):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    score = min(1.0, entropy / 3.0)
    if " " in counts:
        score *= 0.5
    kinds = (any(c.islower() for c in counts), any(c.isupper() for c in counts), any(c.isdigit() for c in counts), any(not c.isalnum() for c in counts))
    return score * (0.55 if sum(kinds) < 2 else 1.0)


def value_score(value: str) -> float:
    """0 to 1: how much a literal looks like key material or a chosen password."""
    return _look_score(len(value), Counter(value), value[:_ENDS], value[-_ENDS:])


def _back(text: str, at: int, chars: frozenset) -> int:
    """Where the run of ``chars`` that ends at ``at`` begins."""
    while at and text[at - 1] in chars:
        at -= 1
    return at


def _name_ending(text: str, at: int) -> str | None:
    """The name that ends at ``at``, from the first letter or underscore of its run."""
    found = _NAME.search(text, _back(text, at, _NAME_CHARS), at)
    return found and found[0]


def _name_left(text: str, at: int) -> str | None:
    """The target that ends at ``at``: a name with a type note, or a name with a quote or bracket behind it.

    Every run is read backwards once, so the time grows with its length alone."""
    end = _back(text, at, _BLANK)
    note = end
    while note and (text[note - 1] in ".[]_" or text[note - 1].isalnum()):
        note -= 1
    colon = _back(text, note, _BLANK)
    if note < end and text[note] in _NAME_FIRST and colon and text[colon - 1] == ":":
        name = _name_ending(text, _back(text, colon - 1, _BLANK))
        if name:
            return name
    end -= end > 0 and text[end - 1] == "]"
    end -= end > 0 and text[end - 1] in "\"'`"
    return _name_ending(text, end)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    return out


def lexed_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of literals that reach sensitive names, directly or through constants."""
    if ("=" not in text and ":" not in text) or not _HINT.search(text):
        return []
    constants: dict[str, _Value] = {}
    reached: dict[int, _Value] = {}  # values whose literals are out already
    out = []
    done = 0
    for m in _OPERATOR.finditer(text):
        at, end = m.span()
        if at < done:
            continue  # inside a literal that has been read
        before, after = text[at - 1 : at], text[end : end + 1]
        if before in ("=", "!", "<", ">", ":", "+") or after in ("=", ":", "/") or (text[at:end] == ":" and after not in (" ", "\t", '"', "'", "`") and before not in ('"', "'")):
            continue  # comparisons, scopes, addresses, clock times
        name = _name_left(text, at)
        if not name:
            continue
        pieces: list[tuple[int, int] | _Value] = []
        through = False
        pos = end
        while a := _ATOM.match(text, pos):
            pos = a.end()
            for group in (2, 4, 5, 7):
                if a[group] is not None:
                    pieces.append(a.span(group))
            if a[6] is not None:
                if a[6] in constants:
                    pieces.append(constants[a[6]])
                    through = True
                elif not _PLUS.match(text, pos) and not pieces and a[6] not in ("None", "null", "true", "false", "True", "False"):
                    pieces.append(a.span(6))  # a bare word as the value of a configuration line
            plus = _PLUS.match(text, pos)
            if not plus:
                break
            pos = plus.end()
        done = max(done, pos)
        if not pieces:
            continue
        value = _Value(pieces)
        if text[at:end] != ":" or through or text[end : end + 2].strip()[:1] in ('"', "'"):
            constants[name] = value
        sensitive = name_score(name)
        if sensitive and sensitive * _look_score(*_look(text, value)) >= THRESHOLD:
            todo = pieces[::-1]
            while todo:
                p = todo.pop()
                if not isinstance(p, _Value):
                    if p[1] > p[0]:
                        out.append((*p, "literal" if p[0] >= end else "propagated"))
                elif id(p) not in reached:
                    reached[id(p)] = p
                    todo += p.parts[::-1]
    return list(dict.fromkeys(out))


_ORDER = {k: i for i, k in enumerate(KINDS)}


def spans(text: str) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then kind."""
    return sorted(base_spans(text) + lexed_spans(text), key=lambda s: (s[0], _ORDER[s[2]], s[1]))


def joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join([f"{k}:{s}:{e}" for s, e, k in found])


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: counts of base spans, their digest, and all spans. No shuffle."""
    keep = ["doc_id"] if keep is None else keep
    kinds = dict(docs.dtypes)
    names = [*keep, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_lexed"]
    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_lexed bigint"

    def run(batches):
        claim("secret_scan")
        for batch in (part for whole in batches for part in text_parts(whole, len(keep))):
            counts, digests, listed = [], [], []
            for text in batch.column(len(keep)).to_pylist():
                found = spans(text or "")
                base = [s for s in found if _ORDER[s[2]] < 3]
                per = Counter(k for _, _, k in found)
                counts.append((per["assign"], per["access"], per["hex"], per["literal"] + per["propagated"]))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                listed.append(joined(found))
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            columns += [pa.array(digests, pa.string()), pa.array(listed, pa.string()), pa.array([c[3] for c in counts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def mask(text: str, filler: str = "[secret]") -> str:
    """The text with every found span replaced (overlapping spans as one)."""
    out, done = [], 0
    for start, end, _ in spans(text):
        if end <= done:
            continue
        if start >= done:
            out += [text[done:start], filler]
        done = end
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in ``text`` (null stays null); n_chars follows if there is one."""
    schema = docs.schema
    at = schema.fieldNames().index("text")

    def run(batches):
        claim("secret_scan")
        for batch in (part for whole in batches for part in text_parts(whole, at)):
            texts = pa.array([None if t is None else mask(t) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    out = docs.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
