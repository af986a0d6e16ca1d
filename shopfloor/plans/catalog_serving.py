"""Registered serving queries (SRV-01..10): dashboard tiles over the reports."""

from __future__ import annotations

from shopfloor.operators import serving as srv
from shopfloor.plans import catalog as c


def q_monthly_revenue_trend(spark, sf_dir):
    return srv.monthly_revenue_trend(c.q_revenue_monthly(spark, sf_dir))


def q_aov_over_time(spark, sf_dir):
    return srv.aov_over_time(c.q_aov_monthly(spark, sf_dir))


def q_top_products(spark, sf_dir):
    return srv.top_products(c.q_top_products_global(spark, sf_dir))


def q_revenue_by_country(spark, sf_dir):
    return srv.revenue_by_country(c.q_revenue_by_country_month(spark, sf_dir))


def q_new_vs_returning_by_month(spark, sf_dir):
    return srv.new_vs_returning_by_month(c.q_new_vs_returning(spark, sf_dir))


def q_retention_trend(spark, sf_dir):
    return srv.retention_trend(c.q_retention_rate(spark, sf_dir))


def q_customers_by_country(spark, sf_dir):
    return srv.customers_by_country(c.q_customers_per_country(spark, sf_dir))


def q_top_customers_by_value(spark, sf_dir):
    return srv.top_customers_by_value(c.q_customer_lifetime_value(spark, sf_dir))


def q_basket_size_trend(spark, sf_dir):
    return srv.basket_size_trend(c.q_basket_size_monthly(spark, sf_dir))


def q_top_product_demand(spark, sf_dir):
    return srv.top_product_demand(c.q_product_demand_trends(spark, sf_dir), c.q_top_products_global(spark, sf_dir))


def queries() -> dict:
    return {
        "srv_monthly_revenue_trend": q_monthly_revenue_trend,
        "srv_aov_over_time": q_aov_over_time,
        "srv_top_products": q_top_products,
        "srv_revenue_by_country": q_revenue_by_country,
        "srv_new_vs_returning_by_month": q_new_vs_returning_by_month,
        "srv_retention_trend": q_retention_trend,
        "srv_customers_by_country": q_customers_by_country,
        "srv_top_customers_by_value": q_top_customers_by_value,
        "srv_basket_size_trend": q_basket_size_trend,
        "srv_top_product_demand": q_top_product_demand,
    }
