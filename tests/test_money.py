from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopfloor.functions.money import money_ratio, money_sum, pct_change, ratio


def _half_up(num: Decimal, den: Decimal, factor=1, scale=2):
    if den == 0:
        return None
    return float((Decimal(factor) * num / den).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))


def test_ratio_ties_and_zero(spark):
    df = spark.createDataFrame(
        [(1001, 200), (-1001, 200), (1, 3), (2, 3), (5, 0), (None, 4), (7, None)], "n long, d long"
    )
    got = [r[0] for r in df.select(ratio(F.col("n"), F.col("d"), scale=2)).collect()]
    # 1001/200 = 5.005 -> 5.01 (half away from zero), not the double-rounding 5.0
    assert got == [5.01, -5.01, 0.33, 0.67, None, None, None]


def test_money_ratio_exact_for_large_denominators(spark):
    # 1.00 + 0.01 spread so the mean sits exactly on a .xx5 boundary with n = 2e6
    n = 2_000_000
    total = Decimal("10010.00")  # mean = 0.005005 -> 0.01
    df = spark.createDataFrame([(str(total), n)], "s string, n long").select(
        money_ratio(F.col("s").cast("decimal(18,2)"), F.col("n"), scale=5)
    )
    assert df.first()[0] == _half_up(total, Decimal(n), scale=5)


@settings(max_examples=25, deadline=None)
@given(
    st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-10**6, 10**6)), min_size=1, max_size=20),
)
def test_ratio_matches_decimal_half_up(spark, pairs):
    df = spark.createDataFrame([(a, b) for a, b in pairs], "a long, b long")
    got = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"), scale=2, factor=100)).collect()]
    want = [_half_up(Decimal(a), Decimal(b), factor=100) for a, b in pairs]
    assert got == want


def test_money_sum_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 1e6 + 0.01, -0.07] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.agg(money_sum("x").cast("double")).first()[0]
    b = df.orderBy(F.rand(3)).repartition(7).agg(money_sum("x").cast("double")).first()[0]
    assert a == b == float(sum(Decimal(str(v)) for v in vals))


def test_pct_change_money_and_units(spark):
    df = spark.createDataFrame([(10.0, 0.0), (15.0, 10.0), (None, 1.0), (3.0, 2.0)], "c double, p double")
    got = [r[0] for r in df.select(pct_change(F.col("c").cast("decimal(18,2)"), F.col("p").cast("decimal(18,2)"),
                                              value_scale=2)).collect()]
    assert got == [None, 50.0, None, 50.0]
