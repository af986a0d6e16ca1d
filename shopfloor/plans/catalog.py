"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Each query reads the supplied tables through the retail adapter and runs a
builder from ``shopfloor.operators``; the fact is derived with only the
columns the builder needs, so unneeded lookups are never joined.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.operators import dimensions as dims
from shopfloor.operators import events as evt
from shopfloor.operators import facts, silver
from shopfloor.operators import quality as dq
from shopfloor.operators import reports as rep
from shopfloor.session import dealt, pin, pin_observed
from shopfloor.sources import adapter, streams
from shopfloor.sources.tables import TableSet

Query = Callable[[SparkSession, str], DataFrame]

# Cohort labels for the supplied data: every first-seen year is its own
# cohort (the original fixed list is ``dims.DEFAULT_COHORT_YEARS``).
COHORT_YEARS = None


def _tables(spark: SparkSession, sf_dir: str) -> TableSet:
    return TableSet(spark, sf_dir)


def _sales(t: TableSet, *cols: str) -> DataFrame:
    return adapter.sales(t, list(cols))


# ── dimensions ───────────────────────────────────────────────────────────────


def _dim_date(t: TableSet) -> DataFrame:
    return dims.dim_date(adapter.sales_lines(t, ["event_time"]))


def _dim_product(t: TableSet) -> DataFrame:
    return dims.dim_product(adapter.sales_lines(t, ["stock_code", "description"]))


def customers_first_seen(t: TableSet) -> DataFrame:
    """Silver-customer stand-in: each identified customer's first sales line
    (any line, sale or cancellation) gives its first-seen time and country."""
    lines = adapter.sales_lines(t, ["customer_id", "country", "event_time"]).withColumnRenamed(
        "event_time", "first_seen_time"
    )
    return dims.earliest_per_customer(lines)


def _dim_customer(t: TableSet) -> DataFrame:
    return dims.dim_customer(customers_first_seen(t), COHORT_YEARS)


def q_dim_date(spark, sf_dir):
    return _dim_date(_tables(spark, sf_dir))


def q_dim_product(spark, sf_dir):
    return _dim_product(_tables(spark, sf_dir))


def q_dim_customer(spark, sf_dir):
    return _dim_customer(_tables(spark, sf_dir))


def q_dim_geography(spark, sf_dir):
    return dims.dim_geography(adapter.sales_lines(_tables(spark, sf_dir), ["country"]))


def q_fact_order_items(spark, sf_dir):
    """Fact rows (business columns) straight from the adapter."""
    cols = [
        "invoice_id", "stock_code", "customer_id", "country", "date_key", "year", "month",
        "quantity", "unit_price", "total_amount", "is_cancelled", "event_time",
    ]
    return adapter.sales_lines(_tables(spark, sf_dir), cols)


# ── reports ──────────────────────────────────────────────────────────────────

_MONEY = ("invoice_id", "quantity", "total_amount")


def q_revenue_daily(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return rep.revenue_daily(_sales(t, "date_key", "year", "month", *_MONEY), _dim_date(t))


def q_revenue_monthly(spark, sf_dir):
    return rep.revenue_monthly(_sales(_tables(spark, sf_dir), "year", "month", *_MONEY))


def q_revenue_yearly(spark, sf_dir):
    return rep.revenue_yearly(_sales(_tables(spark, sf_dir), "year", *_MONEY))


def q_top_products_by_country(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return rep.top_products_by_country(_sales(t, "country", "stock_code", *_MONEY), _dim_product(t))


def q_top_products_global(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return rep.top_products_global(_sales(t, "stock_code", *_MONEY), _dim_product(t))


def q_aov_monthly(spark, sf_dir):
    return rep.aov_monthly(_sales(_tables(spark, sf_dir), "year", "month", "invoice_id", "total_amount"))


def q_aov_overall(spark, sf_dir):
    return rep.aov_overall(_sales(_tables(spark, sf_dir), "invoice_id", "total_amount"))


def q_revenue_by_country_month(spark, sf_dir):
    return rep.revenue_by_country_month(_sales(_tables(spark, sf_dir), "country", "year", "month", *_MONEY))


def q_revenue_by_country_year(spark, sf_dir):
    return rep.revenue_by_country_year(_sales(_tables(spark, sf_dir), "country", "year", *_MONEY))


def q_product_demand_trends(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return rep.product_demand_trends(_sales(t, "stock_code", "year", "month", *_MONEY), _dim_product(t))


def q_new_vs_returning(spark, sf_dir):
    return rep.new_vs_returning(_sales(_tables(spark, sf_dir), "customer_id", "year", "month"))


def q_customer_lifetime_value(spark, sf_dir):
    return rep.customer_lifetime_value(
        _sales(_tables(spark, sf_dir), "customer_id", "event_time", *_MONEY)
    )


def q_customers_per_country(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return rep.customers_per_country(_sales(t, "customer_id", "country", "total_amount"), _dim_customer(t))


def q_top_customers_by_orders(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return rep.top_customers_by_orders(
        _sales(t, "customer_id", "invoice_id", "total_amount", "event_time"), _dim_customer(t)
    )


def q_retention_rate(spark, sf_dir):
    return rep.retention_rate(_sales(_tables(spark, sf_dir), "customer_id", "year", "month"))


def q_basket_size_monthly(spark, sf_dir):
    return rep.basket_size_monthly(
        _sales(_tables(spark, sf_dir), "invoice_id", "year", "month", "stock_code", "quantity", "total_amount")
    )


def q_basket_size_overall(spark, sf_dir):
    return rep.basket_size_overall(
        _sales(_tables(spark, sf_dir), "invoice_id", "year", "month", "stock_code", "quantity", "total_amount")
    )


# ── events -> bronze -> silver -> fact ───────────────────────────────────────

ORDER_EVENT_COLUMNS = [c for c in evt.ORDER_FIELDS if c != "ingestion_time"]
# Registered outputs leave out the replay's transport timestamp (an instant,
# so its text depends on the reader's time zone); it stays in the tables.
SILVER_ORDER_COLUMNS = ["kafka_key", "topic", "partition", "offset", *ORDER_EVENT_COLUMNS, "year", "month"]
SILVER_CUSTOMER_COLUMNS = ["kafka_key", "topic", "event_type", "customer_id", "country", "first_seen_time"]


def order_bronze(t: TableSet) -> DataFrame:
    """Replay of the order topic built from the raw sales lines, which are short:
    they are dealt before each becomes a payload that is parsed and sorted."""
    records = evt.order_records(evt.order_events(dealt(adapter.raw_sales_lines(t))))
    return streams.bronze_envelope(streams.replay_records(records, evt.ORDER_TOPIC))


def customer_bronze(t: TableSet) -> DataFrame:
    records = evt.customer_records(evt.customer_events(adapter.raw_sales_lines(t)))
    return streams.bronze_envelope(streams.replay_records(records, evt.CUSTOMER_TOPIC))


def q_order_events(spark, sf_dir):
    return evt.order_events(adapter.raw_sales_lines(_tables(spark, sf_dir))).select(*ORDER_EVENT_COLUMNS)


def q_customer_events(spark, sf_dir):
    return evt.customer_events(adapter.raw_sales_lines(_tables(spark, sf_dir))).drop("ingestion_time")


def q_order_event_records(spark, sf_dir):
    """Events -> JSON records -> parsed back: the payload round-trips."""
    from shopfloor.functions.json import parse
    from shopfloor.schemas import ORDER_EVENT

    records = evt.order_records(evt.order_events(adapter.raw_sales_lines(_tables(spark, sf_dir))))
    return records.select(parse("value", ORDER_EVENT).alias("e")).select("e.*").drop("ingestion_time")


def q_silver_orders(spark, sf_dir):
    return silver.silver_orders(order_bronze(_tables(spark, sf_dir))).select(*SILVER_ORDER_COLUMNS)


def q_silver_customers(spark, sf_dir):
    return silver.silver_customers(customer_bronze(_tables(spark, sf_dir))).select(*SILVER_CUSTOMER_COLUMNS)


def silver_fact(t: TableSet) -> DataFrame:
    return facts.fact_order_items(silver.silver_orders(order_bronze(t)))


def q_silver_fact_order_items(spark, sf_dir):
    cols = [
        "invoice_id", "stock_code", "customer_id", "country", "date_key", "year", "month",
        "quantity", "unit_price", "total_amount", "is_cancelled", "event_time",
    ]
    return silver_fact(_tables(spark, sf_dir)).select(*cols)


def q_revenue_monthly_from_events(spark, sf_dir):
    """Round trip: raw lines -> events -> bronze -> silver -> fact -> report."""
    return rep.revenue_monthly(rep.confirmed_sales(silver_fact(_tables(spark, sf_dir))))


# ── data-quality checks ──────────────────────────────────────────────────────


@dataclass(frozen=True)
class SilverRun:
    """Silver written once, with what was observed while writing and its side tables."""

    orders: DataFrame
    customers: DataFrame
    observed: dict
    sides: dict


def _silver_run(t: TableSet) -> SilverRun:
    so, seen_o = pin_observed(silver.silver_orders(order_bronze(t)), "silver_orders", dq.order_metrics())
    sc, seen_c = pin_observed(silver.silver_customers(customer_bronze(t)), "silver_customers", dq.customer_metrics())
    return SilverRun(so, sc, seen_o | seen_c, {name: pin(side(so), name) for name, side in dq.SIDES.items()})


def _upstream_counts(t: TableSet) -> dict:
    """Raw lines and customers, and the events made of them (every line with a
    quantity other than 0; one per identified customer), from the columns that decide it."""
    raw = adapter.raw_sales_lines(t, ["Quantity", "Customer ID"])
    row = raw.agg(
        F.count(F.lit(1)).alias("raw_orders"), F.countDistinct("Customer ID").alias("raw_customers"),
        F.count_if(F.col("Quantity") != 0).alias("bronze_orders"),
    ).first()
    return row.asDict() | {"bronze_customers": row["raw_customers"]}


def _silver_checks(t: TableSet, run: SilverRun) -> DataFrame:
    up = _upstream_counts(t)
    return dq.silver_checks(None, None, run.orders, run.customers, sides=run.sides,
                            raw_counts=(up["raw_orders"], up["raw_customers"]), observed=run.observed | up)


def _gold_checks(run: SilverRun) -> DataFrame:
    from shopfloor.plans import gold

    # the fact is a projection of stored silver: read from there, not written a second time
    fact = facts.fact_order_items(run.orders)
    d = gold.dimensions(run.orders, run.customers, COHORT_YEARS, run.sides)
    made = gold.rollups(fact, lambda df, name: pin(df, f"rollup_{name}"), dq.GOLD_CHECK_REPORTS)
    r = gold.reports(made, d, dq.GOLD_CHECK_REPORTS)
    return dq.gold_checks(
        fact, d["dim_product"], d["dim_customer"], d["dim_date"], r["revenue_yearly"], r["revenue_monthly"],
        r["aov_monthly"], rep.customer_values(made["invoice_day"]), r["retention_rate"], r["basket_size_monthly"],
        r["new_vs_returning"], observed=run.observed, sides=run.sides,
    )


def q_dq_silver_checks(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return _silver_checks(t, _silver_run(t))


def q_dq_gold_checks(spark, sf_dir):
    return _gold_checks(_silver_run(_tables(spark, sf_dir)))


def q_dq_orphan_orders(spark, sf_dir):
    """DQ-10 quarantine content: silver orders whose customer is not among
    silver customers (anti-join on the string form of the id)."""
    t = _tables(spark, sf_dir)
    so, sc = silver.silver_orders(order_bronze(t)), silver.silver_customers(customer_bronze(t))
    return dq.orphan_orders(so, sc).select("invoice_id", "stock_code", "customer_id", "event_time", "quantity")


def q_dq_summary(spark, sf_dir):
    """DQ-32: totals by status over both check suites of one run (silver is
    written and observed once and shared by both suites)."""
    t = _tables(spark, sf_dir)
    run = _silver_run(t)
    return dq.summary(_silver_checks(t, run).unionByName(_gold_checks(run)))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "dim_date": q_dim_date,
        "dim_product": q_dim_product,
        "dim_customer": q_dim_customer,
        "dim_geography": q_dim_geography,
        "fact_order_items": q_fact_order_items,
        "revenue_daily": q_revenue_daily,
        "revenue_monthly": q_revenue_monthly,
        "revenue_yearly": q_revenue_yearly,
        "top_products_by_country": q_top_products_by_country,
        "top_products_global": q_top_products_global,
        "aov_monthly": q_aov_monthly,
        "aov_overall": q_aov_overall,
        "revenue_by_country_month": q_revenue_by_country_month,
        "revenue_by_country_year": q_revenue_by_country_year,
        "product_demand_trends": q_product_demand_trends,
        "new_vs_returning": q_new_vs_returning,
        "customer_lifetime_value": q_customer_lifetime_value,
        "customers_per_country": q_customers_per_country,
        "top_customers_by_orders": q_top_customers_by_orders,
        "retention_rate": q_retention_rate,
        "basket_size_monthly": q_basket_size_monthly,
        "basket_size_overall": q_basket_size_overall,
        "order_events": q_order_events,
        "customer_events": q_customer_events,
        "order_event_records": q_order_event_records,
        "silver_orders": q_silver_orders,
        "silver_customers": q_silver_customers,
        "silver_fact_order_items": q_silver_fact_order_items,
        "revenue_monthly_from_events": q_revenue_monthly_from_events,
        "dq_silver_checks": q_dq_silver_checks,
        "dq_gold_checks": q_dq_gold_checks,
        "dq_summary": q_dq_summary,
        "dq_orphan_orders": q_dq_orphan_orders,
    }
    from shopfloor.plans import catalog_profile

    out.update(catalog_profile.queries())
    from shopfloor.plans import catalog_serving

    out.update(catalog_serving.queries())
    return out
