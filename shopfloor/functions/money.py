"""Exact money arithmetic.

Amounts arrive as doubles.  Summing doubles depends on row order, so two runs
(or two engines) can disagree in the last bit and a ``round(x, 2)`` can then
flip.  Every money sum here is exact at the amounts' own scale (a double is
taken as the shortest decimal that denotes it, up to 18 fraction digits), the
same for every row order and partitioning, and is rounded once, at the end.

Two accumulators make that cheap: an amount that is a whole number of
hundredths is added as a ``bigint`` inside generated code, only the others go
through ``decimal(36,18)``.  Sums are themselves amounts, so partial sums merge
exactly (``merge_sum``).

Ratios (averages, percentages) are rounded half away from zero on the exact
quotient using integer arithmetic on unscaled values, so no intermediate
scale cut can cause a double rounding, whatever the size of the denominator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 18
AMOUNT = T.DecimalType(36, SCALE)
CENTS = T.DecimalType(28, 2)
WIDE_INT = T.DecimalType(38, 0)
#: Hundredths up to here are exact in a double, whole and divided by 100.
_MOST_HUNDREDTHS = 1e15


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c: Column | str) -> Column:
    """Exact, unrounded sum of double amounts as an ``AMOUNT``; null without
    amounts.  NaN and infinite amounts denote no decimal and count as missing."""
    x = _col(c).cast(T.DoubleType())
    scaled = F.rint(x * 100)
    whole = (F.abs(scaled) <= _MOST_HUNDREDTHS) & (scaled / 100 == x)
    hundredths = F.sum(F.when(whole, scaled.cast("bigint")))
    finite = ~F.isnan(x) & (F.abs(x) < float("inf"))
    others = F.sum(F.when(~whole & finite, x.cast(AMOUNT))).cast(AMOUNT)
    from_hundredths = (hundredths.cast("decimal(21,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(AMOUNT)
    none = F.lit(0).cast(AMOUNT)
    both = (F.coalesce(from_hundredths, none) + F.coalesce(others, none)).cast(AMOUNT)
    return F.when(hundredths.isNotNull() | others.isNotNull(), both)


def money_count(c: Column | str) -> Column:
    """How many amounts ``money_sum`` adds."""
    x = _col(c).cast(T.DoubleType())
    return F.count_if(~F.isnan(x) & (F.abs(x) < float("inf")))


def merge_sum(c: Column | str) -> Column:
    """Exact sum of ``AMOUNT`` values (partial sums)."""
    return F.sum(_col(c)).cast(AMOUNT)


def to_cents(amount: Column | str) -> Column:
    """An exact amount rounded, once, half away from zero to 2 decimals."""
    return F.round(_col(amount), 2).cast(CENTS)


def money_total(c: Column | str) -> Column:
    """Exact sum of double amounts, rounded once to 2 decimals."""
    return to_cents(money_sum(c))


def as_double(c: Column | str) -> Column:
    return _col(c).cast(T.DoubleType())


def _unscaled(c: Column, scale: int) -> Column:
    """``c * 10**scale`` as a 38-digit integer; exact when ``c`` has at most
    ``scale`` fraction digits."""
    if scale:
        c = c * F.lit(10**scale)
    return c.cast(WIDE_INT)


def ratio(
    num: Column | str,
    den: Column | str,
    scale: int = 2,
    num_scale: int = 0,
    den_scale: int = 0,
    factor: int = 1,
) -> Column:
    """``round(factor * num / den, scale)`` rounded half away from zero, exact.

    ``num`` and ``den`` must be exact values with at most ``num_scale`` /
    ``den_scale`` fraction digits (counts, or 2-decimal money).  Division by
    zero or a null operand gives null (the ANSI-safe ``try_divide`` outcome).
    Returns a double.
    """
    n = _unscaled(_col(num), num_scale)
    d = _unscaled(_col(den), den_scale)
    shift = scale + den_scale - num_scale
    if shift < 0:
        raise ValueError("scale too small for the numerator's fraction digits")
    x = n * F.lit(factor * 10**shift).cast(WIDE_INT)
    # (2|x| + |d|) div (2|d|) == round_half_up(|x| / |d|); ``div`` on decimals
    # is an exact integral division.
    q = F.call_function("div", 2 * F.abs(x) + F.abs(d), 2 * F.abs(d))
    signed = F.when(F.signum(x) * F.signum(d) < 0, -q).otherwise(q)
    return F.when(d == 0, F.lit(None).cast(T.DoubleType())).otherwise(
        signed.cast(T.DoubleType()) / F.lit(float(10**scale))
    )


def money_ratio(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """An exact amount divided by a count, rounded half away from zero to
    ``scale`` decimals on the exact quotient; null when the count is 0."""
    x = (_col(num).cast(AMOUNT) * F.lit(10**scale)).cast(T.DecimalType(34, SCALE - scale))
    d = _col(den).cast("decimal(20,0)")
    q = F.call_function("div", 2 * F.abs(x) + d, 2 * d)
    signed = F.when(x < 0, -q).otherwise(q)
    return F.when(d == 0, F.lit(None).cast(T.DoubleType())).otherwise(
        signed.cast(T.DoubleType()) / F.lit(float(10**scale))
    )


def pct_change(curr: Column | str, prev: Column | str, value_scale: int = 0) -> Column:
    """``round((curr - prev) / prev * 100, 2)``; null when prev is 0 or null."""
    c, p = _col(curr), _col(prev)
    if value_scale:
        c, p = c.cast(T.DecimalType(38, value_scale)), p.cast(T.DecimalType(38, value_scale))
    return ratio(c - p, p, scale=2, num_scale=value_scale, den_scale=value_scale, factor=100)
