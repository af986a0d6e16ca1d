"""Profiling operations on any table (re-aimed from exploration notebooks).

Everything here is a distributed aggregate or join; nothing loops on the
driver.  Where a notebook used a window over a whole key group (duplicate
members, conflicting records, offset gaps), the version here is skew-safe:
counts come from map-side pre-aggregated ``groupBy``s that are joined back,
and offset gaps are found inside bounded offset ranges plus one small pass
over the range edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions.json import json_field, repair_nan
from shopfloor.functions.money import merge_sum, money_ratio, money_sum, ratio
from shopfloor.schemas import ORDER_EVENT
from shopfloor.session import pin

# Case-insensitive literal patterns marking a junk description.
JUNK_DESCRIPTION_PATTERNS = ("?", "error", "sold as", "check", "POSTAGE", "Manual")
FUNNEL_WARN_PCT = 5
OFFSET_RANGE = 1_000_000


def null_counts(df: DataFrame) -> DataFrame:
    """PRO-01: one row, the number of nulls in every column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def value_counts(df: DataFrame, col: Column | str, name: str = "value") -> DataFrame:
    """PRO-02: rows per value of a category (order when displaying)."""
    c = F.col(col) if isinstance(col, str) else col
    return df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).alias("count"))


def value_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per column and distinct value, all columns in one pass: (column,
    value, rows, amount), ``amount`` being the exact sum of the rows' values.
    A value with a third of all rows is one row a task before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    melted = df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")
    return melted.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"), money_sum("value").alias("amount"))


def exact_quantiles(frequencies: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles of (column, value, rows), interpolated between neighbouring
    rows: (column, probability, quantile).

    Selection by ranges: values are dealt to ordered ranges, rows are counted per
    range, and only the ranges that hold a wanted rank are looked into, each
    by a window of its own.  No task holds a column's values."""
    ranged = frequencies.repartitionByRange("column", "value").withColumn("__range", F.spark_partition_id())
    ranged = pin(ranged, "quantile_ranges")
    totals = ranged.groupBy("column", "__range").agg(F.sum("rows").alias("__n"))
    order = Window.partitionBy("column").orderBy("__range")  # one row a range
    before = F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    all_rows = F.sum("__n").over(Window.partitionBy("column"))
    place = F.array(*[F.lit(float(p)) for p in probabilities])
    edges = totals.withColumns({"__before": before, "__last": all_rows - 1}).withColumn("probability", F.explode(place))
    at = F.col("__last") * F.col("probability")
    low = edges.withColumn("__rank", F.floor(at)).withColumn("__part", at - F.floor(at)).withColumn("__side", F.lit("low"))
    wanted = low.unionByName(low.withColumn("__rank", F.ceil(at)).withColumn("__side", F.lit("high")))
    wanted = wanted.filter((F.col("__rank") >= F.col("__before")) & (F.col("__rank") < F.col("__before") + F.col("__n"))).drop("__n", "__last")
    inside = Window.partitionBy("column", "__range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    held = ranged.join(wanted.select("column", "__range").distinct(), ["column", "__range"], "left_semi")
    held = held.withColumn("__inner", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
    # bounded: two rows a column and probability, in the ranges that hold them
    hit = held.join(F.broadcast(wanted), ["column", "__range"]).filter(
        (F.col("__rank") - F.col("__before") >= F.col("__inner")) & (F.col("__rank") - F.col("__before") < F.col("__inner") + F.col("rows"))
    )
    value = lambda side: F.max(F.when(F.col("__side") == side, F.col("value")))
    both = hit.groupBy("column", "probability", "__part").agg(value("low").alias("__low"), value("high").alias("__high"))
    return both.select("column", "probability", (F.col("__low") + (F.col("__high") - F.col("__low")) * F.col("__part")).alias("quantile"))


def describe_numeric(df: DataFrame, cols: Sequence[str], scale: int = 4) -> DataFrame:
    """PRO-03: one row per numeric column: ``count`` of its finite numbers, and of
    these the mean, sample deviation, smallest, quartiles and largest;
    ``left_out`` counts NaN and infinite values, which nothing else takes part in
    (nulls are in no count).  The input is read once.  Mean and quartiles are
    exact; mean and deviation are rounded to ``scale`` places."""
    x = F.col("value")
    finite = ~F.isnan(x) & (F.abs(x) < float("inf"))
    seen = pin(value_frequencies(df, cols).filter(x.isNotNull()), "value_frequencies")
    numbers = seen.filter(finite)
    n = F.coalesce(F.sum(F.when(finite, F.col("rows"))), F.lit(0))
    stats = seen.groupBy("column").agg(
        n.alias("count"),
        F.coalesce(F.sum(F.when(~finite, F.col("rows"))), F.lit(0)).alias("left_out"),
        money_ratio(merge_sum("amount"), n, scale).alias("mean"),
        F.min(F.when(finite, x)).alias("min"),
        F.max(F.when(finite, x)).alias("max"),
        (merge_sum("amount").cast("double") / n).alias("__mean"),
    )
    # bounded: one row a column
    off = numbers.join(F.broadcast(stats.select("column", "__mean")), "column")
    spread = off.groupBy("column").agg(F.sum(F.col("rows") * (x - F.col("__mean")) * (x - F.col("__mean"))).alias("__squares"))
    quartiles = exact_quantiles(numbers.select("column", "value", "rows"), [0.25, 0.5, 0.75])
    named = quartiles.groupBy("column").agg(
        *[F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(q) for p, q in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    )
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    zero = F.lit(0).cast("long")
    out = every.join(stats, "column", "left").join(spread, "column", "left").join(named, "column", "left")
    return out.select(
        "column", F.coalesce("count", zero).alias("count"), F.coalesce("left_out", zero).alias("left_out"), "mean",
        F.when(F.col("count") > 1, F.round(F.sqrt(F.col("__squares") / (F.col("count") - 1)), scale)).alias("stddev"),
        "min", "q1", "median", "q3", "max",
    )


def unreadable_json(bronze: DataFrame, probe_path: str = "$.event_type") -> DataFrame:
    """PRO-04: bronze rows whose JSON cannot be read (the probe field is
    null)."""
    return bronze.filter(json_field("raw_json", probe_path).isNull())


def nan_recovery(bronze: DataFrame, probe_path: str = "$.event_type") -> DataFrame:
    """PRO-05: of the unreadable rows, how many the NaN repair recovers, by
    recovered event type."""
    fixed = repair_nan("raw_json")
    return (
        unreadable_json(bronze, probe_path)
        .select(F.get_json_object(fixed, probe_path).alias("event_type"))
        .filter(F.col("event_type").isNotNull())
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("recovered"))
    )


def offset_gaps(records: DataFrame, range_size: int = OFFSET_RANGE) -> DataFrame:
    """PRO-06: per stream partition, consecutive present offsets more than 1
    apart: (partition, prev_offset, offset, gap).

    Offsets are cut into ranges of ``range_size``; gaps inside a range come
    from a window over that range only, gaps across ranges from the edges
    (min/max) of the non-empty ranges.  No task holds a whole partition.
    """
    o = records.select("partition", "offset").withColumn("__r", F.col("offset") - F.pmod(F.col("offset"), F.lit(range_size)))
    w_in = Window.partitionBy("partition", "__r").orderBy("offset")
    inside = o.withColumn("prev_offset", F.lag("offset").over(w_in)).filter(F.col("prev_offset").isNotNull())
    edges = o.groupBy("partition", "__r").agg(F.min("offset").alias("offset"), F.max("offset").alias("__max"))
    w_edge = Window.partitionBy("partition").orderBy("__r")  # one row per non-empty range
    across = edges.withColumn("prev_offset", F.lag("__max").over(w_edge)).filter(F.col("prev_offset").isNotNull())
    both = inside.select("partition", "prev_offset", "offset").unionByName(
        across.select("partition", "prev_offset", "offset")
    )
    return both.withColumn("gap", F.col("offset") - F.col("prev_offset")).filter(F.col("gap") > 1)


def duplicate_excess(df: DataFrame, key_sets: dict[str, Sequence[str]]) -> DataFrame:
    """PRO-07: for each named key set, rows beyond the first of every group
    (``sum(count - 1)``); one row, one column per set.

    The sets are nested, so the finest is counted from the rows and each coarser
    one from the counts before: one pass, one shuffle of rows."""
    order = sorted(key_sets, key=lambda name: -len(key_sets[name]))
    for finer, coarser in zip(order, order[1:], strict=False):
        if not set(key_sets[coarser]) <= set(key_sets[finer]):
            raise ValueError("key sets must be nested")
    groups, done = df.withColumn("__n", F.lit(1).cast("long")), []
    for name in order:
        groups = groups.groupBy(*key_sets[name]).agg(F.sum("__n").alias("__n"), *[F.sum(d).alias(d) for d in done])
        groups = groups.withColumn(f"__{name}", F.col("__n") - 1)
        done.append(f"__{name}")
    return groups.agg(*[F.coalesce(F.sum(f"__{name}"), F.lit(0)).cast("long").alias(name) for name in key_sets])


def stage_funnel(stages: Sequence[tuple[str, DataFrame]], warn_pct: float = FUNNEL_WARN_PCT) -> DataFrame:
    """PRO-08: row count per stage, rows dropped from the previous stage, the
    drop in percent and a warning flag above ``warn_pct``."""
    parts = [
        df.agg(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows"))
        for i, (name, df) in enumerate(stages)
    ]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    prev = F.lag("rows").over(Window.orderBy("step"))  # one row per stage
    dropped = prev - F.col("rows")
    pct = ratio(dropped, prev, factor=100)
    return counts.select(
        "step", "stage", "rows", dropped.alias("dropped"), pct.alias("dropped_pct"),
        F.coalesce(pct > warn_pct, F.lit(False)).alias("warn"),
    )


def rows_per_spark_partition(df: DataFrame) -> DataFrame:
    """PRO-09: rows in each Spark partition of a DataFrame (layout check)."""
    return df.groupBy(F.spark_partition_id().alias("spark_partition")).agg(F.count(F.lit(1)).alias("rows"))


def file_count(df: DataFrame) -> DataFrame:
    """PRO-09: files that hold the rows of a file-based DataFrame, and its rows (small-file check)."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("__file")).agg(F.count(F.lit(1)).alias("__n"))
    return per_file.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"))


def descriptions_per_code(df: DataFrame, key: str = "stock_code", value: str = "description") -> DataFrame:
    """PRO-10: distinct non-null descriptions per stock code."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("n_descriptions"))


def description_totals(df: DataFrame, key: str = "stock_code", value: str = "description") -> DataFrame:
    """PRO-10: stock codes, those with several descriptions, and distinct (code, description) pairs."""
    pairs = df.groupBy(key, value).agg(F.lit(1).alias("__one"))
    named = F.count_if(F.col(value).isNotNull())
    return pairs.groupBy(key).agg(named.alias("__n"), F.count(F.lit(1)).alias("__pairs")).agg(
        F.count(F.lit(1)).alias("codes"),
        F.count_if(F.col("__n") > 1).alias("codes_with_several_descriptions"),
        F.coalesce(F.sum("__pairs"), F.lit(0)).alias("distinct_pairs"),
    )


def junk_pattern(patterns: Sequence[str] = JUNK_DESCRIPTION_PATTERNS) -> str:
    """Case-insensitive alternation of literal patterns (regex metacharacters
    escaped, so the text works in Java regex and RE2 alike)."""
    meta = set(".^$*+?()[]{}|\\")
    esc = ["".join("\\" + ch if ch in meta else ch for ch in p) for p in patterns]
    return "(?i)(" + "|".join(esc) + ")"


def junk_description_codes(df: DataFrame, patterns: Sequence[str] = JUNK_DESCRIPTION_PATTERNS) -> DataFrame:
    """PRO-11: number of stock codes with at least one junk description."""
    hit = F.col("description").rlike(junk_pattern(patterns))
    return df.filter(hit).agg(F.countDistinct("stock_code").alias("junk_codes"))


def _null_safe_semi(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``keys`` occur in ``keys_df`` (nulls equal)."""
    renamed = keys_df.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"__k{i}"))
        cond = c if cond is None else cond & c
    return df.join(renamed, cond, "left_semi")


def _repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times, by arrays of bounded length."""
    step = 10_000
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / step)))
    each = df.withColumn("__block", blocks).withColumn("__left", F.least(F.lit(step), F.col(times) - F.col("__block") * step))
    return each.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__left").cast("long")))).drop("__block", "__left", "__i")


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PRO-12: every row whose key occurs more than once (all members kept).
    Null keys count as equal.

    The input is read once: equal rows are counted, the counts are summed per
    key, and the few rows of repeated keys are written out as often as they stand."""
    rows = pin(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")), "distinct_rows")
    many = rows.groupBy(*keys).agg(F.sum("__n").alias("__all")).filter(F.col("__all") > 1)
    return _repeated(_null_safe_semi(rows, many.select(*keys), keys), "__n").select(*df.columns)


def full_row_duplicates(df: DataFrame) -> DataFrame:
    """PRO-12: rows that repeat an earlier identical row (``rows - distinct``)."""
    return df.groupBy(*df.columns).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("full_row_duplicates")
    )


def conflicting_records(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """PRO-13: rows sharing ``keys`` with another row but whose
    ``keys + value`` combination is unique (same line, different quantity).

    The input is read once: per ``keys + value`` the rows are counted next to one of
    them, and the counts are rolled up to ``keys`` and joined back."""
    rest = [c for c in df.columns if c not in {*keys, value}]
    one = F.min(F.struct(*rest)).alias("__one") if rest else F.lit(None).alias("__one")
    finest = pin(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"), one), "line_counts")
    shared = finest.groupBy(*keys).agg(F.sum("__n").alias("__all")).filter(F.col("__all") > 1)
    found = _null_safe_semi(finest.filter(F.col("__n") == 1), shared.select(*keys), keys)
    return found.select(*[F.col(f"__one.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def sign_split(df: DataFrame, qty: str = "Quantity", price: str = "Price") -> DataFrame:
    """PRO-14: positive / negative / zero quantities and negative / zero prices."""
    q, p = F.col(qty), F.col(price)
    return df.agg(
        F.count_if(q > 0).alias("positive_quantity"),
        F.count_if(q < 0).alias("negative_quantity"),
        F.count_if(q == 0).alias("zero_quantity"),
        F.count_if(p < 0).alias("negative_price"),
        F.count_if(p == 0).alias("zero_price"),
    )


def first_seen_years(df: DataFrame, customer: str = "Customer ID", time: str = "InvoiceDate") -> DataFrame:
    """PRO-15: customers by the year of their first line."""
    first = df.filter(F.col(customer).isNotNull()).groupBy(customer).agg(F.min(time).alias("__t"))
    return first.groupBy(F.year("__t").alias("first_seen_year")).agg(F.count(F.lit(1)).alias("customers"))


def customer_counts(df: DataFrame, customer: str = "Customer ID") -> DataFrame:
    """PRO-16: distinct customers and lines without a customer."""
    return df.agg(
        F.countDistinct(customer).alias("distinct_customers"),
        F.count_if(F.col(customer).isNull()).alias("missing_customer_rows"),
    )


def rows_per_year(df: DataFrame, time: str = "InvoiceDate") -> DataFrame:
    """PRO-17: rows per calendar year."""
    return df.groupBy(F.year(time).alias("year")).agg(F.count(F.lit(1)).alias("rows"))


def null_or_empty(col: str) -> Column:
    """PRO-18: null or empty, tested on the string form (comparing an int
    column with ``''`` raises under ANSI)."""
    s = F.col(col).cast("string")
    return s.isNull() | (F.trim(s) == "")


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """PRO-19: rows with the given key value."""
    return df.filter(F.col(key) == F.lit(value))


def parse_probe(bronze: DataFrame) -> DataFrame:
    """Payload fields as strings via single-path extracts (no schema)."""
    fields = [f.name for f in ORDER_EVENT.fields]
    return bronze.select(*[json_field("raw_json", f"$.{f}").alias(f) for f in fields])
