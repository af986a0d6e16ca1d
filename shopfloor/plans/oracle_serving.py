"""DuckDB oracle for the serving queries (report SQL nested as CTEs)."""

from __future__ import annotations

from shopfloor.plans.oracle import _reports, dbl, mtotal, with_, ym


def serving_sql() -> dict[str, str]:
    rep = _reports()

    def w(*pairs: tuple[str, str]) -> str:
        return with_(*[f"\n{name} AS ({rep[key]}\n)" for name, key in pairs])

    q: dict[str, str] = {}
    q["srv_monthly_revenue_trend"] = w(("r", "revenue_monthly")) + (
        " SELECT year_month, year, month, total_revenue, prev_month_revenue, mom_change_pct FROM r"
    )
    q["srv_aov_over_time"] = w(("r", "aov_monthly")) + (
        " SELECT year_month, year, month, avg_order_value, total_invoices FROM r"
    )
    q["srv_top_products"] = w(("r", "top_products_global")) + (
        " SELECT * FROM r ORDER BY revenue_rank, stock_code LIMIT 10"
    )
    q["srv_revenue_by_country"] = w(("r", "revenue_by_country_month")) + f"""
SELECT country, {dbl(mtotal('total_revenue'))} AS total_revenue,
       CAST(sum(total_line_items) AS BIGINT) AS total_line_items,
       CAST(sum(total_units_sold) AS BIGINT) AS total_units_sold
FROM r GROUP BY country"""
    q["srv_new_vs_returning_by_month"] = w(("r", "new_vs_returning")) + f"""
SELECT year, month,
       CAST(coalesce(sum(customer_count) FILTER (WHERE customer_type = 'new'), 0) AS BIGINT) AS new_customers,
       CAST(coalesce(sum(customer_count) FILTER (WHERE customer_type = 'returning'), 0) AS BIGINT)
           AS returning_customers,
       {ym()} AS year_month
FROM r GROUP BY year, month"""
    q["srv_retention_trend"] = w(("r", "retention_rate")) + (
        " SELECT year_month, year, month, active_customers, retained_next_month, retention_rate_pct FROM r"
    )
    q["srv_customers_by_country"] = w(("r", "customers_per_country")) + " SELECT * FROM r"
    q["srv_top_customers_by_value"] = w(("r", "customer_lifetime_value")) + (
        " SELECT * FROM r WHERE customer_id_clean <> 'guest' ORDER BY clv_rank, customer_id_clean LIMIT 10"
    )
    q["srv_basket_size_trend"] = w(("r", "basket_size_monthly")) + (
        " SELECT year_month, year, month, avg_basket_size, avg_units_per_order, avg_basket_value FROM r"
    )
    q["srv_top_product_demand"] = w(("d", "product_demand_trends"), ("g", "top_products_global")) + """
SELECT * FROM d WHERE stock_code IN (SELECT stock_code FROM g ORDER BY units_rank, stock_code LIMIT 5)"""
    return q
