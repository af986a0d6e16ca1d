"""Star-schema dimensions (date, product, customer, geography)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions.periods import date_key, is_weekend

# The cohort years, label prefix and fallback label of the
# original customer dimension.
DEFAULT_COHORT_YEARS = (2009, 2010)
COHORT_PREFIX = "cohort_"
UNKNOWN_COHORT = "unknown"


def dim_date(orders: DataFrame, time_col: str = "event_time") -> DataFrame:
    """One row per calendar day from the first to the last event date.

    The range comes from a global min/max aggregate and is expanded with
    ``explode(sequence(...))`` on the executors; nothing goes through the
    driver.  Empty input gives no rows.
    """
    bounds = orders.agg(
        F.min(F.to_date(time_col)).alias("min_date"), F.max(F.to_date(time_col)).alias("max_date")
    )
    days = bounds.filter(F.col("min_date").isNotNull()).select(
        F.explode(F.sequence("min_date", "max_date", F.expr("INTERVAL 1 DAY"))).alias("d")
    )
    return days.select(
        date_key("d").alias("date_key"),
        F.col("d").alias("full_date"),
        F.dayofmonth("d").alias("day"),
        F.month("d").alias("month"),
        F.quarter("d").alias("quarter"),
        F.year("d").alias("year"),
        F.date_format("d", "EEEE").alias("day_of_week"),
        is_weekend("d").alias("is_weekend"),
    )


def most_frequent_per_key(df: DataFrame, key: str, value: str, freq_col: str = "freq", counted: str | None = None) -> DataFrame:
    """Mode of ``value`` per ``key`` among non-null values.

    Ties go to the smallest value, so the result is deterministic.  The window
    runs on (key, value) counts, so a hot key costs one row per distinct value.
    ``counted`` names a column of rows that stand for that many.
    """
    freq = F.sum(counted) if counted else F.count(F.lit(1))
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(freq.alias(freq_col))
    w = Window.partitionBy(key).orderBy(F.col(freq_col).desc(), F.col(value).asc())
    return counts.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).select(key, value)


def dim_product(orders: DataFrame, counted: str | None = None) -> DataFrame:
    """One row per stock code with its most frequent non-null description."""
    return most_frequent_per_key(orders, "stock_code", "description", counted=counted)


def cohort_label(year_col: F.Column, cohort_years: Sequence[int] | None) -> F.Column:
    """``cohort_<year>`` for the listed years (every year when ``None``),
    ``unknown`` otherwise."""
    if cohort_years is None:
        return F.when(year_col.isNotNull(), F.concat(F.lit(COHORT_PREFIX), year_col.cast("string"))).otherwise(
            F.lit(UNKNOWN_COHORT)
        )
    label = F.lit(UNKNOWN_COHORT)
    for y in reversed(list(cohort_years)):
        label = F.when(year_col == y, F.lit(f"{COHORT_PREFIX}{y}")).otherwise(label)
    return label


def dim_customer(customers: DataFrame, cohort_years: Sequence[int] | None = DEFAULT_COHORT_YEARS) -> DataFrame:
    """Customers with first-seen time, year and cohort label."""
    fy = F.year("first_seen_time")
    return customers.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        "country",
        "first_seen_time",
        fy.alias("first_seen_year"),
        cohort_label(fy, cohort_years).alias("cohort"),
    )


def earliest_per_customer(customers: DataFrame) -> DataFrame:
    """One row per customer: the earliest first-seen row (ties: smallest
    country).  Repairs customers announced twice by a replayed producer."""
    # struct order: known times before null times, then time, then country
    first = F.min(F.struct(F.col("first_seen_time").isNull(), "first_seen_time", "country"))
    return (
        customers.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(first.alias("__f"))
        .select("customer_id", F.col("__f.country").alias("country"), F.col("__f.first_seen_time").alias("first_seen_time"))
    )


def dim_geography(orders: DataFrame) -> DataFrame:
    """Distinct non-null countries of orders."""
    return orders.select("country").filter(F.col("country").isNotNull()).distinct()
