"""JSON payload repair and parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The repair patterns.  A bare ``NaN`` after a colon is not
# valid JSON; it is rewritten to ``null`` before parsing.
NAN_PATTERN = r":\s*NaN"
# Strict form: only when the token ends the value (followed by , or }).
NAN_PATTERN_STRICT = r":\s*NaN(\s*[,}])"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repair_nan(raw: Column | str, strict: bool = False) -> Column:
    """Replace ``: NaN`` by ``: null`` in a JSON text.

    The default pattern also rewrites the text ``: NaN`` inside a string value
    (``"note: NaN here"``), as the original pipeline did; ``strict=True``
    narrows that to a token that is followed by ``,`` or ``}``.
    """
    c = _col(raw)
    fixed = (
        F.regexp_replace(c, NAN_PATTERN_STRICT, ": null$1") if strict else F.regexp_replace(c, NAN_PATTERN, ": null")
    )
    # Only a text containing "NaN" can change: a substring test skips the
    # regex engine for (nearly) every row.
    return F.when(c.contains("NaN"), fixed).otherwise(c)


def parse(raw: Column | str, schema: T.StructType) -> Column:
    """Permissive parse: bad JSON gives a null struct, a wrongly typed field
    gives a null field while the others survive."""
    return F.from_json(_col(raw), schema)


def json_field(raw: Column | str, path: str) -> Column:
    """Single-path extract, e.g. ``$.event_type``; null when unreadable."""
    return F.get_json_object(_col(raw), path)


def to_json_record(*cols: Column | str) -> Column:
    """Serialise columns as one JSON object, keeping null fields as ``null``."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def expand_once(df, keep: list[str], struct: Column) -> "DataFrame":  # noqa: F821
    """Columns ``keep`` plus the fields of ``struct``, computed exactly once.

    A filter on a parsed field (``event_time IS NOT NULL``) would otherwise be
    pushed below the projection and the whole parse evaluated twice, once in
    the filter and once in the projection.  Expanding through a one-element
    ``inline`` generator keeps the parse in one place: predicates on the
    generated fields stay above it.  Pass the parsed struct itself (one
    ``from_json``), not a struct of its fields: generator inputs get no
    common-subexpression elimination.  (The operator holding ``from_json``
    runs outside whole-stage codegen either way, as ``from_json`` has no
    generated code; the operators around it stay fused.)
    """
    return df.select(*keep, F.inline(F.array(struct)))
