"""Assemble the gold layer (dimensions, fact, reports) from silver tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from shopfloor.operators import dimensions as dims
from shopfloor.operators import facts
from shopfloor.operators import reports as rep
from shopfloor.operators import rollup
from shopfloor.session import pin

DIMENSIONS = ("dim_date", "dim_product", "dim_customer", "dim_geography")
REPORTS = (
    "revenue_daily", "revenue_monthly", "revenue_yearly", "top_products_by_country", "top_products_global",
    "aov_monthly", "aov_overall", "revenue_by_country_month", "revenue_by_country_year", "product_demand_trends",
    "new_vs_returning", "customer_lifetime_value", "customers_per_country", "top_customers_by_orders",
    "retention_rate", "basket_size_monthly", "basket_size_overall",
)
# Storage folder of each report (revenue & sales, customer analytics, product insights).
REPORT_GROUPS = {
    **{name: "revenue_sales" for name in REPORTS[:10]},
    **{name: "customer_analytics" for name in REPORTS[10:15]},
    **{name: "product_insights" for name in REPORTS[15:]},
}


def dimensions(silver_orders: DataFrame, silver_customers: DataFrame,
               cohort_years: Sequence[int] | None = dims.DEFAULT_COHORT_YEARS,
               sides: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The dimensions; dates and products from the side tables where given."""
    if sides:
        date = dims.dim_date(sides["customer_days"], "day")
        product = dims.dim_product(sides["code_descriptions"], counted="lines")
    else:
        date, product = dims.dim_date(silver_orders), dims.dim_product(silver_orders)
    return {
        "dim_date": date,
        "dim_product": product,
        "dim_customer": dims.dim_customer(silver_customers, cohort_years),
        "dim_geography": dims.dim_geography(silver_orders),
    }


def rollups(fact: DataFrame, store: Callable[[DataFrame, str], DataFrame],
            names: Sequence[str] = REPORTS) -> dict[str, DataFrame]:
    """The roll-ups behind the reports in ``names``; ``store`` writes one and
    returns what reads it back, so each is made once."""
    made: dict[str, DataFrame] = {}
    for name in rollup.needed(names):
        parent = rollup.PARENT[name]
        src = made[parent] if parent else rep.confirmed_sales(fact)
        made[name] = store(rollup.roll_up(src, name), name)
    return made


def reports(source: DataFrame | Mapping[str, DataFrame], d: Mapping[str, DataFrame],
            names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The reports in ``names`` (all 17 by default) from the fact, or from its
    roll-ups by name.  Only requested reports are built: the ranked ones pin
    their value ranges when built."""
    builders = {
        "revenue_daily": lambda s: rep.revenue_daily(s, d["dim_date"]),
        "revenue_monthly": rep.revenue_monthly,
        "revenue_yearly": rep.revenue_yearly,
        "top_products_by_country": lambda s: rep.top_products_by_country(s, d["dim_product"]),
        "top_products_global": lambda s: rep.top_products_global(s, d["dim_product"]),
        "aov_monthly": rep.aov_monthly,
        "aov_overall": rep.aov_overall,
        "revenue_by_country_month": rep.revenue_by_country_month,
        "revenue_by_country_year": rep.revenue_by_country_year,
        "product_demand_trends": lambda s: rep.product_demand_trends(s, d["dim_product"]),
        "new_vs_returning": rep.new_vs_returning,
        "customer_lifetime_value": rep.customer_lifetime_value,
        "customers_per_country": lambda s: rep.customers_per_country(s, d["dim_customer"]),
        "top_customers_by_orders": lambda s: rep.top_customers_by_orders(s, d["dim_customer"]),
        "retention_rate": rep.retention_rate,
        "basket_size_monthly": rep.basket_size_monthly,
        "basket_size_overall": rep.basket_size_overall,
    }
    lines = rep.confirmed_sales(source) if isinstance(source, DataFrame) else None
    return {n: builders[n](lines if lines is not None else source[rollup.SOURCE[n]]) for n in (names or REPORTS)}


def gold_from_silver(silver_orders: DataFrame, silver_customers: DataFrame,
                     cohort_years: Sequence[int] | None = dims.DEFAULT_COHORT_YEARS,
                     report_names: Sequence[str] | None = None, fact: DataFrame | None = None,
                     sides: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    d = dimensions(silver_orders, silver_customers, cohort_years, sides)
    fact = facts.fact_order_items(silver_orders) if fact is None else fact
    made = rollups(fact, lambda df, name: pin(df, f"rollup_{name}"), report_names or REPORTS)
    return {**d, "fact_order_items": fact, **reports(made, d, report_names)}
