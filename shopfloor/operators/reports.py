"""Gold reporting datasets over the order-line fact.

Inputs are the fact's ``sales`` subset (``is_cancelled = false``), or a roll-up
of it (``operators.rollup``) that has the builder's keys, and the dimensions.
Conventions shared by every builder:

* the four measures (``revenue``, ``lines``, ``units``, ...) aggregate order
  lines, or merge the partial sums of a roll-up; the result is the same;
* money is summed exactly, rounded once and returned as double;
* "lines" = ``count(invoice_id)``, "units" = ``sum(quantity)``;
* averages and percentages are exact half-up roundings (``functions.money``);
* joins to a dimension happen after aggregating the fact down to the
  dimension key, so the big side is pre-aggregated before any shuffle;
* windows run on aggregated rows: per-key windows are bounded by the key's
  distinct sub-keys, whole-table orderings over unbounded sets (products,
  customers) use ``global_dense_rank`` instead of a one-task window;
  month-level windows are bounded by the calendar.
* builders do not sort; order at read / serve time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions.money import as_double, merge_sum, money_count, money_ratio, money_sum, pct_change, ratio, to_cents
from shopfloor.functions.periods import period_index, year_month
from shopfloor.operators.ranking import global_dense_rank, global_dense_ranks

REV, LINES, UNITS = "total_revenue", "total_line_items", "total_units_sold"

# Labels and cut-offs of the original reports.
GUEST = "guest"
NEW, RETURNING = "new", "returning"
TOP_PER_COUNTRY = 20


def confirmed_sales(fact: DataFrame) -> DataFrame:
    """Fact rows that are sales (cancellations and null flags removed)."""
    return fact.filter(~F.col("is_cancelled"))


# Partial sums of a roll-up: exact revenue, lines with an invoice, units, lines
# with a stock code, amounts behind the revenue, first and last event time.
P_REV, P_LINES, P_UNITS, P_ITEMS, P_AMOUNTS, P_FIRST, P_LAST = (
    "p_revenue", "p_lines", "p_units", "p_items", "p_amounts", "p_first_time", "p_last_time",
)


def is_rollup(src: DataFrame) -> bool:
    return P_REV in src.columns


def revenue(src: DataFrame) -> F.Column:
    """Exact, unrounded revenue."""
    return merge_sum(P_REV) if is_rollup(src) else money_sum("total_amount")


def lines(src: DataFrame) -> F.Column:
    return F.sum(P_LINES) if is_rollup(src) else F.count("invoice_id")


def units(src: DataFrame) -> F.Column:
    return F.sum(P_UNITS) if is_rollup(src) else F.sum("quantity")


def items(src: DataFrame) -> F.Column:
    """Lines with a stock code (not distinct codes)."""
    return F.sum(P_ITEMS) if is_rollup(src) else F.count("stock_code")


def amounts(src: DataFrame) -> F.Column:
    return F.sum(P_AMOUNTS) if is_rollup(src) else money_count("total_amount")


def first_time(src: DataFrame) -> F.Column:
    return F.min(P_FIRST if is_rollup(src) else "event_time")


def last_time(src: DataFrame) -> F.Column:
    return F.max(P_LAST if is_rollup(src) else "event_time")


def _rev_lines_units(src: DataFrame) -> list[F.Column]:
    return [to_cents(revenue(src)).alias(REV), lines(src).alias(LINES), units(src).alias(UNITS)]


# ── revenue & sales ──────────────────────────────────────────────────────────


def revenue_daily(sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue, lines and units per calendar day with the day's attributes.
    Days without sales are absent."""
    per_day = sales.groupBy("date_key", "year", "month").agg(*_rev_lines_units(sales))
    days = dim_date.select("date_key", "full_date", "day", "day_of_week", "is_weekend")
    return per_day.join(days, "date_key").select(
        "full_date", "year", "month", "day", "day_of_week", "is_weekend",
        as_double(REV).alias(REV), LINES, UNITS,
    )


def revenue_monthly(sales: DataFrame) -> DataFrame:
    """Monthly revenue with the previous *present* month's revenue and the
    change in percent."""
    w = Window.orderBy("year", "month")  # one row per month: bounded
    monthly = sales.groupBy("year", "month").agg(*_rev_lines_units(sales)).withColumn("__prev", F.lag(REV, 1).over(w))
    prev = F.col("__prev")  # one window evaluation, referenced twice below
    return monthly.select(
        "year", "month", as_double(REV).alias(REV), LINES, UNITS,
        year_month().alias("year_month"),
        as_double(prev).alias("prev_month_revenue"),
        pct_change(F.col(REV), prev, value_scale=2).alias("mom_change_pct"),
    )


def revenue_yearly(sales: DataFrame) -> DataFrame:
    return sales.groupBy("year").agg(*_rev_lines_units(sales)).select(
        "year", as_double(REV).alias(REV), LINES, UNITS
    )


def _product_totals(sales: DataFrame, dim_product: DataFrame, keys: list[str]) -> DataFrame:
    """Revenue/units/lines per ``keys`` (which include stock_code), with the
    product description joined after aggregation."""
    agg = sales.groupBy(*keys).agg(*_rev_lines_units(sales))
    return agg.join(dim_product.select("stock_code", "description"), "stock_code", "left")


def top_products_by_country(sales: DataFrame, dim_product: DataFrame, top_n: int = TOP_PER_COUNTRY) -> DataFrame:
    """Per country, products by revenue; dense rank on rounded revenue, ranks
    up to ``top_n`` kept (ties share a rank)."""
    totals = _product_totals(sales, dim_product, ["country", "stock_code"])
    w = Window.partitionBy("country").orderBy(F.col(REV).desc())
    ranked = totals.withColumn("country_rank", F.dense_rank().over(w)).filter(F.col("country_rank") <= top_n)
    return ranked.select(
        "country", "stock_code", "description", as_double(REV).alias(REV), UNITS, LINES, "country_rank"
    )


def top_products_global(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Every product with its revenue rank and units rank (no cut-off)."""
    totals = _product_totals(sales, dim_product, ["stock_code"])
    ranked = global_dense_ranks(totals, [(REV, "revenue_rank", True), (UNITS, "units_rank", True)])
    return ranked.select(
        "stock_code", "description", as_double(REV).alias(REV), UNITS, LINES, "revenue_rank", "units_rank"
    )


def _invoice_revenue(sales: DataFrame, keys: list[str]) -> DataFrame:
    return sales.groupBy(*keys).agg(revenue(sales).alias("invoice_revenue"))


def _aov_aggs() -> list[F.Column]:
    return [
        money_ratio(merge_sum("invoice_revenue"), F.count("invoice_revenue")).alias("avg_order_value"),
        F.count("invoice_id").alias("total_invoices"),
        as_double(to_cents(merge_sum("invoice_revenue"))).alias("total_revenue"),
    ]


def aov_monthly(sales: DataFrame) -> DataFrame:
    """Mean invoice revenue per month (an invoice spanning two months counts
    in each)."""
    per_invoice = _invoice_revenue(sales, ["year", "month", "invoice_id"])
    return per_invoice.groupBy("year", "month").agg(*_aov_aggs()).select(
        "year", "month", "avg_order_value", "total_invoices", "total_revenue", year_month().alias("year_month")
    )


def aov_overall(sales: DataFrame) -> DataFrame:
    return _invoice_revenue(sales, ["invoice_id"]).agg(*_aov_aggs())


def revenue_by_country_month(sales: DataFrame) -> DataFrame:
    return sales.groupBy("country", "year", "month").agg(*_rev_lines_units(sales)).select(
        "country", "year", "month", as_double(REV).alias(REV), LINES, UNITS, year_month().alias("year_month")
    )


def revenue_by_country_year(sales: DataFrame) -> DataFrame:
    return sales.groupBy("country", "year").agg(*_rev_lines_units(sales)).select(
        "country", "year", as_double(REV).alias(REV), LINES, UNITS
    )


def product_demand_trends(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Units per product and month with the previous present month's units."""
    agg = sales.groupBy("stock_code", "year", "month").agg(
        units(sales).alias("units_sold"),
        to_cents(revenue(sales)).alias("revenue"),
        lines(sales).alias("order_line_count"),
    ).join(dim_product.select("stock_code", "description"), "stock_code", "left")
    w = Window.partitionBy("stock_code").orderBy("year", "month")  # rows: months of one product
    agg = agg.withColumn("__prev", F.lag("units_sold", 1).over(w))
    prev = F.col("__prev")
    return agg.select(
        "stock_code", "description", "year", "month", "units_sold", as_double("revenue").alias("revenue"),
        "order_line_count", year_month().alias("year_month"),
        prev.alias("prev_month_units"),
        pct_change(F.col("units_sold"), prev).alias("mom_units_change_pct"),
    )


# ── customer analytics ───────────────────────────────────────────────────────


def _monthly_active(sales: DataFrame) -> DataFrame:
    """Distinct (customer, year, month) of identified customers."""
    return sales.filter(F.col("customer_id").isNotNull()).select("customer_id", "year", "month").distinct()


def new_vs_returning(sales: DataFrame) -> DataFrame:
    """Customers per month split into new (first month with a sale) and
    returning.  Guests are excluded."""
    active = _monthly_active(sales).withColumn("period", period_index())
    first = F.min("period").over(Window.partitionBy("customer_id"))  # rows: months of one customer
    tagged = active.withColumn(
        "customer_type", F.when(F.col("period") == first, F.lit(NEW)).otherwise(F.lit(RETURNING))
    )
    return tagged.groupBy("year", "month", "customer_type").agg(
        F.count("customer_id").alias("customer_count")
    ).select("year", "month", "customer_type", "customer_count", year_month().alias("year_month"))


def customer_values(sales: DataFrame) -> DataFrame:
    """Per customer (all guests as one ``guest`` row): revenue, orders, mean
    line value, units, first/last order time and order value."""
    per = sales.withColumn("customer_id_clean", F.coalesce(F.col("customer_id"), F.lit(GUEST))).groupBy(
        "customer_id_clean"
    ).agg(
        to_cents(revenue(sales)).alias("__rev"),
        F.countDistinct("invoice_id").alias("total_orders"),
        money_ratio(revenue(sales), amounts(sales)).alias("avg_line_item_value"),
        units(sales).alias("total_units_purchased"),
        first_time(sales).alias("first_order_date"),
        last_time(sales).alias("last_order_date"),
    )
    return per.select(
        "customer_id_clean", as_double("__rev").alias("lifetime_revenue"), "total_orders", "avg_line_item_value",
        "total_units_purchased", "first_order_date", "last_order_date",
        money_ratio(F.col("__rev"), F.col("total_orders")).alias("avg_order_value"),
    )


def customer_lifetime_value(sales: DataFrame) -> DataFrame:
    """``customer_values`` with the rank by lifetime revenue."""
    return global_dense_rank(customer_values(sales), "lifetime_revenue", "clv_rank")


def customers_per_country(sales: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Registered customers per (first-seen) country with the revenue of
    identified customers' sales in that country."""
    heads = dim_customer.groupBy("country").agg(F.count("customer_id").alias("total_customers"))
    known = sales.filter(F.col("customer_id").isNotNull())
    per_country = known.groupBy("country").agg(to_cents(revenue(sales)).alias("__rev"))
    joined = heads.join(per_country, "country", "left")
    return joined.select(
        "country", "total_customers", as_double("__rev").alias("total_revenue"),
        money_ratio(F.col("__rev"), F.col("total_customers")).alias("revenue_per_customer"),
    )


def top_customers_by_orders(sales: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Identified customers by distinct invoices, with country and cohort."""
    per = (
        sales.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.countDistinct("invoice_id").alias("total_orders"),
            as_double(to_cents(revenue(sales))).alias("total_revenue"),
            first_time(sales).alias("first_order_date"),
            last_time(sales).alias("last_order_date"),
        )
        .join(dim_customer.select("customer_id", "country", "cohort"), "customer_id", "left")
    )
    ranked = global_dense_rank(per, "total_orders", "order_rank")
    return ranked.select(
        "customer_id", "total_orders", "total_revenue", "first_order_date", "last_order_date",
        "country", "cohort", "order_rank",
    )


def retention_rate(sales: DataFrame) -> DataFrame:
    """Customers active in a month and how many of them are active in the
    next calendar month.  The last month always shows 0 retained.

    Equivalent to the self-join on (customer, period + 1): on distinct
    (customer, period) rows the next row of the same customer is the next
    month exactly when its period is one more.  ``lead`` over the customer's
    months does it in the same shuffle as the de-duplication's consumer,
    without a second scan or join.
    """
    active = _monthly_active(sales).withColumn("period", period_index())
    nxt = F.lead("period", 1).over(Window.partitionBy("customer_id").orderBy("period"))
    flagged = active.withColumn("__kept", (nxt == F.col("period") + 1).cast("int"))
    per = flagged.groupBy("year", "month").agg(
        F.count("customer_id").alias("active_customers"),
        F.coalesce(F.sum("__kept"), F.lit(0)).cast("long").alias("retained_next_month"),
    )
    return per.select(
        "year", "month", "active_customers", "retained_next_month",
        ratio(F.col("retained_next_month"), F.col("active_customers"), factor=100).alias("retention_rate_pct"),
        year_month().alias("year_month"),
    )


# ── product insights ─────────────────────────────────────────────────────────


def _baskets(sales: DataFrame) -> DataFrame:
    """Per invoice and month: line count (``count(stock_code)``, not
    distinct), units and value."""
    return sales.groupBy("invoice_id", "year", "month").agg(
        items(sales).alias("line_item_count"),
        units(sales).alias("total_units"),
        revenue(sales).alias("basket_value"),
    )


def _basket_aggs() -> list[F.Column]:
    return [
        ratio(F.sum("line_item_count"), F.count("line_item_count")).alias("avg_basket_size"),
        ratio(F.sum("total_units"), F.count("total_units")).alias("avg_units_per_order"),
        money_ratio(merge_sum("basket_value"), F.count("basket_value")).alias("avg_basket_value"),
        F.count("invoice_id").alias("total_invoices"),
    ]


def basket_size_monthly(sales: DataFrame) -> DataFrame:
    return _baskets(sales).groupBy("year", "month").agg(*_basket_aggs()).select(
        "year", "month", "avg_basket_size", "avg_units_per_order", "avg_basket_value", "total_invoices",
        year_month().alias("year_month"),
    )


def basket_size_overall(sales: DataFrame) -> DataFrame:
    return _baskets(sales).agg(*_basket_aggs())
