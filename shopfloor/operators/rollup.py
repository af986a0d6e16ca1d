"""Roll-ups of the sales: partial sums from which every report is read.

Two of them are made from the fact, the others from these, so 17 reports cost
two scans of it:

```
sales -> invoice_day    invoice x day x customer x country
           -> day_country       day x country
           -> customer_month    customer x month x country
sales -> product_month  product x month x country
```

Each row holds mergeable partial sums (``reports.P_*``): exact revenue, counts
and units add up, first and last times take the minimum and maximum, and distinct
invoices or customers are read from keys.  So a report has the same value from
the fact and from any roll-up that has its keys; ``SOURCE`` names the smallest.
All aggregates combine in the map tasks; keys that are null are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopfloor.operators import reports as rep

KEYS = {
    "invoice_day": ("invoice_id", "date_key", "year", "month", "customer_id", "country"),
    "product_month": ("stock_code", "year", "month", "country"),
    "day_country": ("date_key", "year", "month", "country"),
    "customer_month": ("customer_id", "year", "month", "country"),
}
#: What a roll-up is made from: None is the fact's sales.
PARENT = {"invoice_day": None, "product_month": None, "day_country": "invoice_day", "customer_month": "invoice_day"}
#: The smallest roll-up that holds a report.
SOURCE = {
    "revenue_daily": "day_country",
    "revenue_monthly": "day_country",
    "revenue_yearly": "day_country",
    "revenue_by_country_month": "day_country",
    "revenue_by_country_year": "day_country",
    "top_products_by_country": "product_month",
    "top_products_global": "product_month",
    "product_demand_trends": "product_month",
    "aov_monthly": "invoice_day",
    "aov_overall": "invoice_day",
    "basket_size_monthly": "invoice_day",
    "basket_size_overall": "invoice_day",
    "customer_lifetime_value": "invoice_day",
    "top_customers_by_orders": "invoice_day",
    "customers_per_country": "customer_month",
    "new_vs_returning": "customer_month",
    "retention_rate": "customer_month",
}


def roll_up(src: DataFrame, name: str) -> DataFrame:
    """The roll-up ``name`` of sales lines, or of a finer roll-up."""
    return src.groupBy(*KEYS[name]).agg(
        rep.revenue(src).alias(rep.P_REV),
        rep.lines(src).alias(rep.P_LINES),
        rep.units(src).alias(rep.P_UNITS),
        rep.items(src).alias(rep.P_ITEMS),
        rep.amounts(src).alias(rep.P_AMOUNTS),
        rep.first_time(src).alias(rep.P_FIRST),
        rep.last_time(src).alias(rep.P_LAST),
    )


def needed(report_names) -> list[str]:
    """Roll-ups behind the given reports, parents first."""
    wanted = {SOURCE[n] for n in report_names}
    wanted |= {PARENT[n] for n in wanted if PARENT[n]}
    return [n for n in KEYS if n in wanted]
