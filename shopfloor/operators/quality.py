"""Data-quality checks with one unified metric schema.

Each check result is a row ``(pipeline, layer, check_name, expected, actual,
status, details)``; ``with_run`` adds ``run_id`` and ``run_timestamp``.

How it runs: row-level checks are named metrics (``order_metrics``,
``customer_metrics``, ``fact_metrics``).  A run that writes the tables observes
them while writing, in the tasks that write, so checking costs no second scan;
without observed values the same metrics are one aggregate over the stored
table.  Grouped questions (orphans, months, days, codes) are read from two side
tables of counts, ``customer_days`` and ``code_descriptions``, each made by one
pass.  The one-row results are stacked with ``unionByName`` and collapsed
into a single row of named scalars (``scalar_row``) -- no cross join, nothing
computed on the driver -- and the check rows are expressions over that row.

Statuses: PASS, WARN, FAIL.  A ratio whose denominator is 0 is null and the
check is WARN (or FAIL where the rule says so), never an error.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions.money import AMOUNT, merge_sum, money_ratio, money_sum, money_total, ratio
from shopfloor.functions.periods import date_key, year_month
from shopfloor.operators.events import ORDER_CREATED, ORDER_EVENT_TYPES
from shopfloor.schemas import METRICS

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
CHECK_COLUMNS = ["pipeline", "layer", "check_name", "expected", "actual", "status", "details"]

# Fixed values of the original checks (used when no upstream table is given).
RAW_ORDERS_COUNT = 525461
RAW_CUSTOMERS_COUNT = 4383
SILVER_ORDERS_COUNT = 518446
DATE_RANGE_MIN = "2009-12-01"
DATE_RANGE_MAX_EXPECTED = "2010-12-31"
DATE_RANGE_MAX_REQUIRED = "2010-12-09"
ORDER_NULL_THRESHOLDS = (
    ("invoice_id", 0.0), ("stock_code", 0.0), ("event_time", 0.0),
    ("event_type", 0.0), ("customer_id", 25.0), ("description", 1.0),
)
CUSTOMER_NULL_THRESHOLDS = (("customer_id", 0.0), ("first_seen_time", 0.0))
FACT_KEY_COLUMNS = ("invoice_id", "stock_code", "date_key", "country")
ANOMALY_DEVIATION = (3, 10)  # 30 % of the mean, as a fraction
MOM_UPPER, MOM_LOWER = 200, -80

# The texts recorded for each check (expected / actual /
# details), in check order.  ``{name}`` marks a value filled in from the data.
TEXTS = {
    "zero.expected": "0",
    "row_count_vs_raw.details": "Drop: {pct}%",
    "row_count_vs_bronze.details.orders": "Drop: {pct}% (expected: dedup only)",
    "row_count_vs_bronze.details.customers": "Drop: {pct}%",
    "null_check.expected": "<={limit}%",
    "null_check.actual": "{pct}%",
    "null_check.details": "{n} nulls out of {total}",
    "duplicate_check.details.orders": "Duplicates remaining after dedup on (invoice_id, stock_code, event_time, quantity)",
    "duplicate_check.details.customers": "Duplicate customer_ids in silver",
    "business_rule_zero_quantity.details": "Rows where quantity = 0",
    "business_rule_negative_price.details": "Rows where unit_price < 0",
    "business_rule_event_type_values.details": "Rows with unexpected event_type values",
    "referential_integrity_customer_id.details": "{n} orders have customer_id not found in customers silver",
    "anomaly_zero_revenue_months.details": "Months with zero revenue",
    "anomaly_monthly_revenue_deviation.expected": "within 30% of mean (£{mean})",
    "anomaly_monthly_revenue_deviation.month": "{year_month}: £{revenue}",
    "anomaly_monthly_revenue_deviation.details": "Anomalous months: {months}",
    "anomaly_monthly_revenue_deviation.details.none": "None",
    "row_count_vs_silver.details": "Difference: {n} rows",
    "null_check_key.details": "{n} nulls in {column}",
    "event_split.expected": ">0",
    "event_split_created.details": "order_item_created count in fact",
    "event_split_cancelled.details": "order_item_cancelled count in fact",
    "no_negative_total_amount.details": "Rows with negative total_amount (should be 0 — absolute values stored)",
    "no_negative_quantity.details": "Rows with negative quantity (should be 0 — absolute values stored)",
    "referential_integrity_date_key.details": "{n} date_keys in fact not found in dim_date",
    "referential_integrity_stock_code.details": "{n} stock_codes in fact not found in dim_product",
    "duplicate_stock_codes.details": "Duplicate stock_codes in dim_product",
    "null_descriptions.details": "{n} products with null description",
    "duplicate_customer_ids.details": "Duplicate customer_ids in dim_customer",
    "date_range_min.details": "Earliest date in dim_date",
    "date_range_max.details": "Latest date in dim_date",
    "revenue_reconciliation_vs_fact.details": "Difference: £{diff}",
    "no_zero_revenue_months.details": "{n} months with zero or negative revenue",
    "extreme_mom_change.details": "{n} months with extreme MoM revenue change (>200% or <-80%)",
    "aov_positive.expected": ">0",
    "aov_positive.details": "Min AOV across months: £{min}",
    "no_negative_clv.details": "{n} customers with negative lifetime revenue",
    "clv_customer_count.details": "Expected dim_customer ({n}) + 1 guest = {expected}",
    "retention_rate_bounds.expected": "0-100%",
    "retention_rate_bounds.actual": "{n} violations",
    "retention_rate_bounds.details": "Retention rate must be between 0 and 100",
    "basket_size_min.expected": ">=1",
    "basket_size_min.details": "Minimum avg basket size across months: {min}",
    "new_customers_every_month.details": "Months missing 'new' customer records: {n}",
}

_SLOT = re.compile(r"\{(\w+)\}")


def template_parts(key: str) -> list[tuple[str, str]]:
    """``TEXTS[key]`` split into ("lit", text) and ("slot", name) parts."""
    t, parts, pos = TEXTS[key], [], 0
    for m in _SLOT.finditer(t):
        if m.start() > pos:
            parts.append(("lit", t[pos:m.start()]))
        parts.append(("slot", m.group(1)))
        pos = m.end()
    if pos < len(t):
        parts.append(("lit", t[pos:]))
    return parts


def text(key: str, **values: Column) -> Column:
    """Render ``TEXTS[key]`` with column values in its slots."""
    cols = [F.lit(v) if kind == "lit" else values[v] for kind, v in template_parts(key)]
    return cols[0] if len(cols) == 1 else F.concat(*cols)


# Reports read by the gold checks, besides the customers' lifetime values (ranks are not).
GOLD_CHECK_REPORTS = (
    "revenue_yearly", "revenue_monthly", "aov_monthly", "retention_rate", "basket_size_monthly", "new_vs_returning",
)


# ── building blocks ──────────────────────────────────────────────────────────


def scalar_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack one-row aggregates with distinct column names into one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def num_text(c: Column) -> Column:
    """Text of a number rounded to 2 places the way Python prints a float
    (``12.5``, ``0.0``, ``12.35``); ``null`` when missing."""
    s = F.regexp_replace(c.cast("decimal(38,2)").cast("string"), "0$", "")
    return F.coalesce(s, F.lit("null"))


def int_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def _t(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def check(pipeline: str, layer: str, name: str, expected, actual, status: Column, details) -> Column:
    return F.struct(
        F.lit(pipeline).alias("pipeline"), F.lit(layer).alias("layer"), F.lit(name).alias("check_name"),
        _t(expected).cast("string").alias("expected"), _t(actual).cast("string").alias("actual"),
        status.alias("status"), _t(details).cast("string").alias("details"),
    )


def check_rows(scalars: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return scalars.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def zero_rule(n: Column, bad: str) -> Column:
    """PASS when the count is 0, else ``bad``."""
    return F.when(n == 0, F.lit(PASS)).otherwise(F.lit(bad))


def pct(num: Column, den: Column) -> Column:
    """``round(num / den * 100, 2)``; null when den is 0."""
    return ratio(num, den, factor=100)


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _dupe_groups(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return _count(df.groupBy(*keys).count().filter(F.col("count") > 1), name)


def _keyed_stats(df: DataFrame, key: str, dupes: str, name: str, other: Column) -> DataFrame:
    """Keys that occur more than once and ``other`` over all rows, in one pass."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), other.alias("__other"))
    return per_key.agg(F.count_if(F.col("__n") > 1).alias(dupes), F.coalesce(F.sum("__other"), F.lit(0)).alias(name))


def _float_text(v: float) -> str:
    return str(float(v))


# ── silver checks (20 results) ───────────────────────────────────────────────


def order_metrics() -> list[Column]:
    """Row-level checks of silver orders, as aggregates to observe or run."""
    return [
        F.count(F.lit(1)).alias("silver_orders"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_o_{c}") for c, _ in ORDER_NULL_THRESHOLDS],
        F.count_if(F.col("quantity") == 0).alias("zero_qty"),
        F.count_if(F.col("unit_price") < 0).alias("neg_price"),
        F.count_if(~F.col("event_type").isin(*ORDER_EVENT_TYPES)).alias("bad_event_type"),
    ]


def customer_metrics() -> list[Column]:
    """Row-level checks of silver customers."""
    return [
        F.count(F.lit(1)).alias("silver_customers"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_c_{c}") for c, _ in CUSTOMER_NULL_THRESHOLDS],
    ]


def fact_metrics() -> list[Column]:
    """Row-level checks of the fact, and its revenue."""
    return [
        F.count(F.lit(1)).alias("fact_count"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_f_{k}") for k in FACT_KEY_COLUMNS],
        F.count_if(~F.col("is_cancelled")).alias("created_count"),
        F.count_if(F.col("is_cancelled")).alias("cancelled_count"),
        F.count_if(F.col("total_amount") < 0).alias("neg_amount"),
        F.count_if(F.col("quantity") < 0).alias("neg_qty"),
        money_total(F.when(~F.col("is_cancelled"), F.col("total_amount"))).alias("fact_revenue"),
    ]


def customer_days(orders: DataFrame) -> DataFrame:
    """Side table: per customer and day the lines, created lines and their exact revenue."""
    created = F.col("event_type") == ORDER_CREATED
    return orders.groupBy("customer_id", "year", "month", F.to_date("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(created).alias("created_lines"),
        money_sum(F.when(created, F.col("total_amount"))).alias("created_revenue"),
    )


def code_descriptions(orders: DataFrame) -> DataFrame:
    """Side table: lines per stock code and description."""
    return orders.groupBy("stock_code", "description").agg(F.count(F.lit(1)).alias("lines"))


#: Side tables of silver orders by name.
SIDES: dict[str, Callable[[DataFrame], DataFrame]] = {"customer_days": customer_days, "code_descriptions": code_descriptions}


def _known(like: DataFrame, observed: Mapping[str, object] | None, metrics: Sequence[str]) -> DataFrame | None:
    """One row of observed values, or None unless all of them were observed."""
    if observed is None or any(m not in observed for m in metrics):
        return None
    types = {"fact_revenue": "decimal(28,2)"}
    return like.sparkSession.range(1).select(*[F.lit(observed[m]).cast(types.get(m, "bigint")).alias(m) for m in metrics])


ORDER_METRICS = ("silver_orders", *(f"null_o_{c}" for c, _ in ORDER_NULL_THRESHOLDS), "zero_qty", "neg_price", "bad_event_type")
CUSTOMER_METRICS = ("silver_customers", *(f"null_c_{c}" for c, _ in CUSTOMER_NULL_THRESHOLDS))
FACT_METRICS = ("fact_count", *(f"null_f_{k}" for k in FACT_KEY_COLUMNS), "created_count", "cancelled_count", "neg_amount", "neg_qty", "fact_revenue")


def _measured(df: DataFrame, observed: Mapping[str, object] | None, metrics: Sequence[Column], names: Sequence[str]) -> DataFrame:
    known = _known(df, observed, names)
    return df.agg(*metrics) if known is None else known


def _monthly_revenue_stats(days: DataFrame) -> DataFrame:
    """Zero-revenue months and months more than 30 % away from the mean of
    the created-order revenue per month (bounded: one row per month)."""
    monthly = (
        days.filter(F.col("created_lines") > 0)
        .groupBy("year", "month")
        .agg(merge_sum("created_revenue").alias("rev"))
    )
    whole = Window.partitionBy(F.lit(0))  # one row per month: bounded
    s, n = F.sum("rev").over(whole).cast(AMOUNT), F.count("rev").over(whole)
    num, den = ANOMALY_DEVIATION
    # |rev - S/N| > 0.3 * S/N  <=>  den * |rev*N - S| > num * S, exact at 10 decimals of a month's sum
    wide, months = "decimal(28,10)", "decimal(4,0)"
    flagged = monthly.withColumns(
        {
            "__mean": money_ratio(s, n),
            "__anom": F.abs(F.col("rev").cast(wide) * n.cast(months) - s.cast(wide)) * den > s.cast(wide) * num,
            "__label": text("anomaly_monthly_revenue_deviation.month", year_month=year_month(),
                            revenue=num_text(F.col("rev"))),
        }
    )
    return flagged.agg(
        F.count_if(F.col("rev") == 0).alias("zero_rev_months"),
        F.count_if("__anom").alias("anomalous_months"),
        F.max("__mean").alias("mean_revenue"),
        F.concat_ws(
            ", ",
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("__anom"), F.struct("year", "month", "__label")))),
                lambda x: x["__label"],
            ),
        ).alias("anomalous_list"),
    )


def silver_checks(
    orders_bronze: DataFrame | None,
    customers_bronze: DataFrame | None,
    orders_silver: DataFrame,
    customers_silver: DataFrame,
    raw: DataFrame | None = None,
    raw_counts: tuple[int, int] | None = None,
    observed: Mapping[str, object] | None = None,
    sides: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Bronze-vs-raw, silver-vs-bronze, nulls, duplicates, business rules,
    referential integrity and revenue anomalies.  The expected raw counts
    (lines, distinct customers) come from ``raw_counts`` when known (e.g.
    observed while publishing), else from a scan of ``raw`` (the raw sales
    lines), else the fixed counts of the original run.  ``observed`` holds
    metrics measured while the tables were written (with the bronze counts among
    them the bronze tables are not read), ``sides`` stored side tables."""
    if raw_counts is not None:
        raw_part = orders_silver.sparkSession.range(1).select(
            F.lit(raw_counts[0]).cast("long").alias("raw_orders"),
            F.lit(raw_counts[1]).cast("long").alias("raw_customers"),
        )
    elif raw is not None:
        raw_part = raw.agg(
            F.count(F.lit(1)).alias("raw_orders"), F.countDistinct("Customer ID").alias("raw_customers")
        )
    else:
        raw_part = orders_silver.sparkSession.range(1).select(
            F.lit(RAW_ORDERS_COUNT).cast("long").alias("raw_orders"),
            F.lit(RAW_CUSTOMERS_COUNT).cast("long").alias("raw_customers"),
        )
    o = orders_silver
    days = (sides or {}).get("customer_days") or customer_days(o)
    known = customers_silver.select(F.col("customer_id").cast("string").alias("__cid")).distinct()
    orphans = days.filter(F.col("customer_id").isNotNull()).join(
        known, days["customer_id"].cast("string") == known["__cid"], "left_anti"
    ).agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("orphans"))
    bronze_parts = [
        _count(df, name) if known_count is None else known_count
        for df, name in ((orders_bronze, "bronze_orders"), (customers_bronze, "bronze_customers"))
        for known_count in (_known(o, observed, [name]),)
    ]
    s = scalar_row(
        [
            raw_part,
            *bronze_parts,
            _measured(o, observed, order_metrics(), ORDER_METRICS),
            _measured(customers_silver, observed, customer_metrics(), CUSTOMER_METRICS),
            _dupe_groups(o, ["invoice_id", "stock_code", "event_time", "quantity"], "order_dupes"),
            _dupe_groups(customers_silver, ["customer_id"], "customer_dupes"),
            orphans,
            _monthly_revenue_stats(days),
        ]
    )
    c = F.col
    zero = text("zero.expected")
    rows: list[Column] = []
    for pipeline, raw_c, bronze_c in (
        ("retail_orders", "raw_orders", "bronze_orders"),
        ("retail_customers", "raw_customers", "bronze_customers"),
    ):
        p = pct(c(raw_c) - c(bronze_c), c(raw_c))
        rows.append(check(pipeline, "bronze", "row_count_vs_raw", int_text(c(raw_c)), int_text(c(bronze_c)),
                          F.when(p < 1, PASS).otherwise(WARN), text("row_count_vs_raw.details", pct=num_text(p))))
    for pipeline, bronze_c, silver_c, limit, which in (
        ("retail_orders", "bronze_orders", "silver_orders", 5, "orders"),
        ("retail_customers", "bronze_customers", "silver_customers", 1, "customers"),
    ):
        p = pct(c(bronze_c) - c(silver_c), c(bronze_c))
        rows.append(check(pipeline, "silver", "row_count_vs_bronze", int_text(c(bronze_c)), int_text(c(silver_c)),
                          F.when(p < limit, PASS).otherwise(WARN),
                          text(f"row_count_vs_bronze.details.{which}", pct=num_text(p))))
    for pipeline, total_c, prefix, thresholds in (
        ("retail_orders", "silver_orders", "null_o_", ORDER_NULL_THRESHOLDS),
        ("retail_customers", "silver_customers", "null_c_", CUSTOMER_NULL_THRESHOLDS),
    ):
        for col_name, limit in thresholds:
            n = c(prefix + col_name)
            p = pct(n, c(total_c))
            rows.append(check(pipeline, "silver", f"null_check_{col_name}",
                              text("null_check.expected", limit=F.lit(_float_text(limit))),
                              text("null_check.actual", pct=num_text(p)), F.when(p <= limit, PASS).otherwise(WARN),
                              text("null_check.details", n=int_text(n), total=int_text(c(total_c)))))
    rows += [
        check("retail_orders", "silver", "duplicate_check", zero, int_text(c("order_dupes")),
              zero_rule(c("order_dupes"), FAIL), text("duplicate_check.details.orders")),
        check("retail_customers", "silver", "duplicate_check", zero, int_text(c("customer_dupes")),
              zero_rule(c("customer_dupes"), FAIL), text("duplicate_check.details.customers")),
        check("retail_orders", "silver", "business_rule_zero_quantity", zero, int_text(c("zero_qty")),
              zero_rule(c("zero_qty"), FAIL), text("business_rule_zero_quantity.details")),
        check("retail_orders", "silver", "business_rule_negative_price", zero, int_text(c("neg_price")),
              zero_rule(c("neg_price"), WARN), text("business_rule_negative_price.details")),
        check("retail_orders", "silver", "business_rule_event_type_values", zero, int_text(c("bad_event_type")),
              zero_rule(c("bad_event_type"), FAIL), text("business_rule_event_type_values.details")),
        check("retail_orders", "silver", "referential_integrity_customer_id", zero, int_text(c("orphans")),
              zero_rule(c("orphans"), WARN),
              text("referential_integrity_customer_id.details", n=int_text(c("orphans")))),
        check("retail_orders", "silver", "anomaly_zero_revenue_months", zero, int_text(c("zero_rev_months")),
              zero_rule(c("zero_rev_months"), FAIL), text("anomaly_zero_revenue_months.details")),
        check("retail_orders", "silver", "anomaly_monthly_revenue_deviation",
              text("anomaly_monthly_revenue_deviation.expected", mean=num_text(c("mean_revenue"))),
              int_text(c("anomalous_months")), zero_rule(c("anomalous_months"), WARN),
              F.when(c("anomalous_months") > 0,
                     text("anomaly_monthly_revenue_deviation.details", months=c("anomalous_list")))
              .otherwise(text("anomaly_monthly_revenue_deviation.details.none"))),
    ]
    return check_rows(s, rows)


def orphan_orders(orders_silver: DataFrame, customers_silver: DataFrame) -> DataFrame:
    """Order rows whose (non-null) customer id is not among silver customers:
    the quarantine content of the referential-integrity check."""
    known = customers_silver.select(F.col("customer_id").cast("string").alias("__cid")).distinct()
    return orders_silver.filter(F.col("customer_id").isNotNull()).join(
        known, orders_silver["customer_id"].cast("string") == known["__cid"], "left_anti"
    )


# ── gold checks (25 results) ─────────────────────────────────────────────────


def gold_checks(
    fact: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    dim_date: DataFrame,
    revenue_yearly: DataFrame,
    revenue_monthly: DataFrame,
    aov_monthly: DataFrame,
    clv: DataFrame,
    retention: DataFrame,
    basket_size_monthly: DataFrame,
    new_vs_returning: DataFrame,
    silver_orders: DataFrame | None = None,
    date_min: str = DATE_RANGE_MIN,
    date_max_expected: str = DATE_RANGE_MAX_EXPECTED,
    date_max_required: str = DATE_RANGE_MAX_REQUIRED,
    observed: Mapping[str, object] | None = None,
    sides: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Fact against silver, key and sign rules, referential integrity,
    dimensions, and the reports' plausibility (``observed`` and ``sides`` as in
    ``silver_checks``)."""
    spark = fact.sparkSession
    if observed and "silver_orders" in observed:
        silver_part = _known(fact, observed, ["silver_orders"]).withColumnRenamed("silver_orders", "silver_count")
    elif silver_orders is not None:
        silver_part = _count(silver_orders, "silver_count")
    else:
        silver_part = spark.range(1).select(F.lit(SILVER_ORDERS_COUNT).cast("long").alias("silver_count"))
    fact_part = _measured(fact, observed, fact_metrics(), FACT_METRICS)
    if sides:
        dates = sides["customer_days"].select(date_key("day").alias("date_key")).distinct()
        codes = sides["code_descriptions"].select("stock_code").distinct()
    else:
        dates, codes = fact.select("date_key").distinct(), fact.select("stock_code").distinct()
    orphan_dates = _count(dates.join(dim_date.select("date_key"), "date_key", "left_anti"), "orphan_dates")
    orphan_products = _count(codes.join(dim_product.select("stock_code"), "stock_code", "left_anti"), "orphan_products")
    nvr = new_vs_returning
    parts = [
        silver_part,
        fact_part,
        orphan_dates,
        orphan_products,
        _keyed_stats(dim_product, "stock_code", "product_dupes", "null_desc", F.count_if(F.col("description").isNull())),
        _keyed_stats(dim_customer, "customer_id", "customer_dupes", "dim_customer_count", F.count(F.lit(1))),
        dim_date.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date")),
        revenue_yearly.agg(money_total("total_revenue").alias("yearly_revenue")),
        revenue_monthly.agg(
            F.count_if(F.col("total_revenue") <= 0).alias("zero_rev_months"),
            F.count_if((F.col("mom_change_pct") > MOM_UPPER) | (F.col("mom_change_pct") < MOM_LOWER)).alias(
                "extreme_mom"
            ),
        ),
        aov_monthly.agg(F.min("avg_order_value").alias("min_aov")),
        clv.agg(F.count_if(F.col("lifetime_revenue") < 0).alias("neg_clv"), F.count(F.lit(1)).alias("clv_count")),
        retention.agg(
            F.count_if((F.col("retention_rate_pct") < 0) | (F.col("retention_rate_pct") > 100)).alias(
                "bad_retention"
            )
        ),
        basket_size_monthly.agg(F.min("avg_basket_size").alias("min_basket")),
        nvr.groupBy("year", "month").agg(F.max(F.col("customer_type") == "new").alias("__new")).agg(
            F.count(F.lit(1)).alias("months_total"), F.count_if("__new").alias("months_with_new")
        ),
    ]
    s = scalar_row(parts)
    c = F.col
    zero = text("zero.expected")
    fo = "fact_order_items"

    def count_check(table: str, name: str, scalar: str, bad: str, **slots: Column) -> Column:
        v = c(scalar)
        return check(table, "gold", name, zero, int_text(v), zero_rule(v, bad), text(f"{name}.details", **slots))

    rows: list[Column] = [
        check(fo, "gold", "row_count_vs_silver", int_text(c("silver_count")), int_text(c("fact_count")),
              F.when(c("fact_count") == c("silver_count"), PASS).otherwise(FAIL),
              text("row_count_vs_silver.details", n=int_text(F.abs(c("fact_count") - c("silver_count"))))),
    ]
    for k in FACT_KEY_COLUMNS:
        n = c(f"null_f_{k}")
        rows.append(check(fo, "gold", f"null_check_{k}", zero, int_text(n), zero_rule(n, FAIL),
                          text("null_check_key.details", n=int_text(n), column=F.lit(k))))
    rows += [
        check(fo, "gold", "event_split_created", text("event_split.expected"), int_text(c("created_count")),
              F.when(c("created_count") > 0, PASS).otherwise(FAIL), text("event_split_created.details")),
        check(fo, "gold", "event_split_cancelled", text("event_split.expected"), int_text(c("cancelled_count")),
              F.when(c("cancelled_count") > 0, PASS).otherwise(FAIL), text("event_split_cancelled.details")),
        count_check(fo, "no_negative_total_amount", "neg_amount", FAIL),
        count_check(fo, "no_negative_quantity", "neg_qty", FAIL),
        count_check(fo, "referential_integrity_date_key", "orphan_dates", FAIL, n=int_text(c("orphan_dates"))),
        count_check(fo, "referential_integrity_stock_code", "orphan_products", FAIL,
                    n=int_text(c("orphan_products"))),
        count_check("dim_product", "duplicate_stock_codes", "product_dupes", FAIL),
        count_check("dim_product", "null_descriptions", "null_desc", WARN, n=int_text(c("null_desc"))),
        count_check("dim_customer", "duplicate_customer_ids", "customer_dupes", FAIL),
        check("dim_date", "gold", "date_range_min", date_min, int_text(c("min_date")),
              F.when(c("min_date").cast("string") <= date_min, PASS).otherwise(WARN), text("date_range_min.details")),
        check("dim_date", "gold", "date_range_max", date_max_expected, int_text(c("max_date")),
              F.when(c("max_date").cast("string") >= date_max_required, PASS).otherwise(WARN),
              text("date_range_max.details")),
        check("revenue_yearly", "gold", "revenue_reconciliation_vs_fact", num_text(c("fact_revenue")),
              num_text(c("yearly_revenue")),
              F.when(F.abs(c("fact_revenue") - c("yearly_revenue")) < 1, PASS).otherwise(FAIL),
              text("revenue_reconciliation_vs_fact.details",
                   diff=F.abs(c("fact_revenue") - c("yearly_revenue")).cast("decimal(38,2)").cast("string"))),
        count_check("revenue_monthly", "no_zero_revenue_months", "zero_rev_months", FAIL,
                    n=int_text(c("zero_rev_months"))),
        check("revenue_monthly", "gold", "extreme_mom_change", zero, int_text(c("extreme_mom")),
              F.when(c("extreme_mom") > 0, WARN).otherwise(PASS),
              text("extreme_mom_change.details", n=int_text(c("extreme_mom")))),
        check("aov_monthly", "gold", "aov_positive", text("aov_positive.expected"), num_text(c("min_aov")),
              F.when(c("min_aov") > 0, PASS).otherwise(FAIL), text("aov_positive.details", min=num_text(c("min_aov")))),
        count_check("customer_lifetime_value", "no_negative_clv", "neg_clv", FAIL, n=int_text(c("neg_clv"))),
        check("customer_lifetime_value", "gold", "clv_customer_count", int_text(c("dim_customer_count") + 1),
              int_text(c("clv_count")), F.when(c("clv_count") == c("dim_customer_count") + 1, PASS).otherwise(WARN),
              text("clv_customer_count.details", n=int_text(c("dim_customer_count")),
                   expected=int_text(c("dim_customer_count") + 1))),
        check("retention_rate", "gold", "retention_rate_bounds", text("retention_rate_bounds.expected"),
              text("retention_rate_bounds.actual", n=int_text(c("bad_retention"))),
              zero_rule(c("bad_retention"), FAIL), text("retention_rate_bounds.details")),
        check("basket_size_monthly", "gold", "basket_size_min", text("basket_size_min.expected"),
              num_text(c("min_basket")), F.when(c("min_basket") >= 1, PASS).otherwise(FAIL),
              text("basket_size_min.details", min=num_text(c("min_basket")))),
        check("new_vs_returning", "gold", "new_customers_every_month", int_text(c("months_total")),
              int_text(c("months_with_new")), F.when(c("months_total") == c("months_with_new"), PASS).otherwise(WARN),
              text("new_customers_every_month.details", n=int_text(c("months_total") - c("months_with_new")))),
    ]
    return check_rows(s, rows)


# ── run bookkeeping ──────────────────────────────────────────────────────────


def new_run_id(now: _dt.datetime | None = None) -> str:
    """UTC ``%Y%m%d_%H%M%S`` run id."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%d_%H%M%S")


def with_run(checks: DataFrame, run_id: str) -> DataFrame:
    """Metric rows in the unified schema (run id and time added)."""
    required = {"pipeline": "", "layer": "", "check_name": "", "status": WARN}
    cols = [F.coalesce(F.col(c), F.lit(required[c])).alias(c) if c in required else F.col(c) for c in CHECK_COLUMNS]
    return checks.select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("run_timestamp"), *cols).to(METRICS)


def summary(metrics: DataFrame) -> DataFrame:
    """Totals by status (PASS / WARN / FAIL) plus the overall count."""
    return metrics.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))
