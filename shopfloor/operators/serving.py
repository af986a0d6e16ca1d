"""Serving queries: the dashboard tiles, as functions over gold tables.

Every input here is already aggregated (months, countries, products,
customers), so the sorts are over small tables; the top-n tiles use
``orderBy(...).limit(n)``, which Spark plans as a per-partition top-n
(``TakeOrderedAndProject``) instead of a full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.money import as_double, money_total
from shopfloor.functions.periods import year_month
from shopfloor.operators.reports import GUEST

# Tile sizes named by the original dashboards.
TOP_PRODUCTS, TOP_CUSTOMERS, TOP_DEMAND_PRODUCTS = 10, 10, 5


def monthly_revenue_trend(revenue_monthly: DataFrame) -> DataFrame:
    """SRV-01: monthly revenue with month-over-month change, in month order."""
    return revenue_monthly.select(
        "year_month", "year", "month", "total_revenue", "prev_month_revenue", "mom_change_pct"
    ).orderBy("year", "month")


def aov_over_time(aov_monthly: DataFrame) -> DataFrame:
    """SRV-02: average order value per month."""
    return aov_monthly.select("year_month", "year", "month", "avg_order_value", "total_invoices").orderBy(
        "year", "month"
    )


def top_products(top_products_global: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """SRV-03: the ``n`` best products by revenue (ties by stock code)."""
    return top_products_global.orderBy("revenue_rank", "stock_code").limit(n)


def revenue_by_country(revenue_by_country_month: DataFrame) -> DataFrame:
    """SRV-04: revenue, lines and units per country over all months."""
    return revenue_by_country_month.groupBy("country").agg(
        as_double(money_total("total_revenue")).alias("total_revenue"),
        F.sum("total_line_items").alias("total_line_items"),
        F.sum("total_units_sold").alias("total_units_sold"),
    )


def new_vs_returning_by_month(new_vs_returning: DataFrame) -> DataFrame:
    """SRV-05: one row per month with new and returning customer counts."""
    return new_vs_returning.groupBy("year", "month").agg(
        F.coalesce(F.sum(F.when(F.col("customer_type") == "new", F.col("customer_count"))), F.lit(0))
        .cast("long").alias("new_customers"),
        F.coalesce(F.sum(F.when(F.col("customer_type") == "returning", F.col("customer_count"))), F.lit(0))
        .cast("long").alias("returning_customers"),
    ).withColumn("year_month", year_month())


def retention_trend(retention_rate: DataFrame) -> DataFrame:
    """SRV-06: monthly retention rate."""
    return retention_rate.select(
        "year_month", "year", "month", "active_customers", "retained_next_month", "retention_rate_pct"
    ).orderBy("year", "month")


def customers_by_country(customers_per_country: DataFrame) -> DataFrame:
    """SRV-07: registered customers per country, most first."""
    return customers_per_country.orderBy(F.col("total_customers").desc(), F.col("country"))


def top_customers_by_value(clv: DataFrame, n: int = TOP_CUSTOMERS, include_guest: bool = False) -> DataFrame:
    """SRV-08: the ``n`` customers with the highest lifetime revenue."""
    src = clv if include_guest else clv.filter(F.col("customer_id_clean") != GUEST)
    return src.orderBy("clv_rank", "customer_id_clean").limit(n)


def basket_size_trend(basket_size_monthly: DataFrame) -> DataFrame:
    """SRV-09: monthly basket size."""
    return basket_size_monthly.select(
        "year_month", "year", "month", "avg_basket_size", "avg_units_per_order", "avg_basket_value"
    ).orderBy("year", "month")


def top_product_demand(product_demand_trends: DataFrame, top_products_global: DataFrame,
                       n: int = TOP_DEMAND_PRODUCTS) -> DataFrame:
    """SRV-10: monthly demand of the ``n`` products with the most units."""
    best = top_products_global.orderBy("units_rank", "stock_code").limit(n).select("stock_code")
    return product_demand_trends.join(best, "stock_code", "left_semi")


# The ten tables published to the serving database.
SERVING_TABLES = (
    "revenue_monthly", "revenue_by_country_month", "top_products_global", "aov_monthly", "new_vs_returning",
    "customer_lifetime_value", "customers_per_country", "retention_rate", "product_demand_trends",
    "basket_size_monthly",
)
