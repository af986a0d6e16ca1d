"""DuckDB oracle for the data-quality check suites (same texts and rules)."""

from __future__ import annotations

from shopfloor.operators import quality as dq
from shopfloor.plans.oracle import (
    CUSTOMER_EVENTS, DIM_DATE, DIM_PRODUCT, GOLD_LINES, ORDER_EVENTS, SALES_LINES, SILVER_ORDERS,
    _reports, dim_customer_cte, money_ratio, money_units, msum, mtotal, ratio, with_, ym,
)


def num_text(x: str) -> str:
    return f"coalesce(regexp_replace(CAST(CAST({x} AS DECIMAL(38,2)) AS VARCHAR), '0$', ''), 'null')"


def int_text(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'null')"


def lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def text_sql(key: str, **values: str) -> str:
    """Render ``quality.TEXTS[key]`` as a SQL string expression."""
    parts = [lit(v) if kind == "lit" else f"({values[v]})" for kind, v in dq.template_parts(key)]
    return " || ".join(parts)


def pct(num: str, den: str) -> str:
    return ratio(num, den, factor=100)


def zero_rule(n: str, bad: str) -> str:
    return f"CASE WHEN {n} = 0 THEN 'PASS' ELSE '{bad}' END"


def row(pipeline, layer, name, expected, actual, status, details) -> str:
    return (
        f"SELECT {lit(pipeline)} AS pipeline, {lit(layer)} AS layer, {lit(name)} AS check_name, "
        f"CAST({expected} AS VARCHAR) AS expected, CAST({actual} AS VARCHAR) AS actual, "
        f"{status} AS status, CAST({details} AS VARCHAR) AS details FROM s"
    )


def silver_checks_sql() -> str:
    ctes = with_(SALES_LINES, ORDER_EVENTS, SILVER_ORDERS, dim_customer_cte(), CUSTOMER_EVENTS) + """,
silver_customers AS (SELECT CAST(customer_id AS VARCHAR) AS customer_id, country,
                            CAST(first_seen_time AS TIMESTAMP) AS first_seen_time FROM customer_events),
monthly AS (SELECT year, month, """ + msum("total_amount") + """ AS rev FROM silver_orders
            WHERE event_type = 'order_item_created' GROUP BY year, month),
mstats AS (SELECT sum(rev) AS s_rev, count(rev) AS n_rev FROM monthly),
munits AS (SELECT *, """ + money_units("rev") + """ AS u FROM monthly),
mflag AS (SELECT *, 10 * abs(u * count(u) OVER () - sum(u) OVER ()) > 3 * sum(u) OVER () AS anom
          FROM munits),
s AS (SELECT
  (SELECT count(*) FROM sales_lines) AS raw_orders,
  (SELECT count(DISTINCT customer_id) FROM sales_lines) AS raw_customers,
  (SELECT count(*) FROM order_events) AS bronze_orders,
  (SELECT count(*) FROM customer_events) AS bronze_customers,
  (SELECT count(*) FROM silver_orders) AS silver_orders,
""" + ",\n".join(
        f"  (SELECT count(*) FROM silver_orders WHERE {c} IS NULL) AS null_o_{c}" for c, _ in dq.ORDER_NULL_THRESHOLDS
    ) + """,
  (SELECT count(*) FROM silver_orders WHERE quantity = 0) AS zero_qty,
  (SELECT count(*) FROM silver_orders WHERE unit_price < 0) AS neg_price,
  (SELECT count(*) FROM silver_orders WHERE NOT (event_type IN ('order_item_created', 'order_item_cancelled')))
      AS bad_event_type,
  (SELECT count(*) FROM silver_customers) AS silver_customers,
""" + ",\n".join(
        f"  (SELECT count(*) FROM silver_customers WHERE {c} IS NULL) AS null_c_{c}"
        for c, _ in dq.CUSTOMER_NULL_THRESHOLDS
    ) + """,
  (SELECT count(*) FROM (SELECT 1 FROM silver_orders GROUP BY invoice_id, stock_code, event_time, quantity
                         HAVING count(*) > 1)) AS order_dupes,
  (SELECT count(*) FROM (SELECT 1 FROM silver_customers GROUP BY customer_id HAVING count(*) > 1)) AS customer_dupes,
  (SELECT count(*) FROM silver_orders o WHERE o.customer_id IS NOT NULL AND NOT EXISTS
      (SELECT 1 FROM silver_customers c WHERE c.customer_id = CAST(o.customer_id AS VARCHAR))) AS orphans,
  (SELECT count(*) FROM monthly WHERE rev = 0) AS zero_rev_months,
  (SELECT count(*) FROM mflag WHERE anom) AS anomalous_months,
  (SELECT """ + money_ratio("s_rev", "n_rev") + """ FROM mstats) AS mean_revenue,
  (SELECT string_agg(""" + text_sql("anomaly_monthly_revenue_deviation.month", year_month=ym(),
                                    revenue=num_text("rev")) + """, ', ' ORDER BY year, month)
     FROM mflag WHERE anom) AS anomalous_list
)
"""
    zero = text_sql("zero.expected")
    rows = []
    for pipeline, raw_c, bronze_c in (
        ("retail_orders", "raw_orders", "bronze_orders"),
        ("retail_customers", "raw_customers", "bronze_customers"),
    ):
        p = pct(f"{raw_c} - {bronze_c}", raw_c)
        rows.append(row(pipeline, "bronze", "row_count_vs_raw", int_text(raw_c), int_text(bronze_c),
                        f"CASE WHEN {p} < 1 THEN 'PASS' ELSE 'WARN' END",
                        text_sql("row_count_vs_raw.details", pct=num_text(p))))
    for pipeline, bronze_c, silver_c, limit, which in (
        ("retail_orders", "bronze_orders", "silver_orders", 5, "orders"),
        ("retail_customers", "bronze_customers", "silver_customers", 1, "customers"),
    ):
        p = pct(f"{bronze_c} - {silver_c}", bronze_c)
        rows.append(row(pipeline, "silver", "row_count_vs_bronze", int_text(bronze_c), int_text(silver_c),
                        f"CASE WHEN {p} < {limit} THEN 'PASS' ELSE 'WARN' END",
                        text_sql(f"row_count_vs_bronze.details.{which}", pct=num_text(p))))
    for pipeline, total_c, prefix, thresholds in (
        ("retail_orders", "silver_orders", "null_o_", dq.ORDER_NULL_THRESHOLDS),
        ("retail_customers", "silver_customers", "null_c_", dq.CUSTOMER_NULL_THRESHOLDS),
    ):
        for col, limit in thresholds:
            n = prefix + col
            p = pct(n, total_c)
            rows.append(row(pipeline, "silver", f"null_check_{col}",
                            text_sql("null_check.expected", limit=lit(str(float(limit)))),
                            text_sql("null_check.actual", pct=num_text(p)),
                            f"CASE WHEN {p} <= {limit} THEN 'PASS' ELSE 'WARN' END",
                            text_sql("null_check.details", n=int_text(n), total=int_text(total_c))))
    rows += [
        row("retail_orders", "silver", "duplicate_check", zero, int_text("order_dupes"),
            zero_rule("order_dupes", "FAIL"), text_sql("duplicate_check.details.orders")),
        row("retail_customers", "silver", "duplicate_check", zero, int_text("customer_dupes"),
            zero_rule("customer_dupes", "FAIL"), text_sql("duplicate_check.details.customers")),
        row("retail_orders", "silver", "business_rule_zero_quantity", zero, int_text("zero_qty"),
            zero_rule("zero_qty", "FAIL"), text_sql("business_rule_zero_quantity.details")),
        row("retail_orders", "silver", "business_rule_negative_price", zero, int_text("neg_price"),
            zero_rule("neg_price", "WARN"), text_sql("business_rule_negative_price.details")),
        row("retail_orders", "silver", "business_rule_event_type_values", zero, int_text("bad_event_type"),
            zero_rule("bad_event_type", "FAIL"), text_sql("business_rule_event_type_values.details")),
        row("retail_orders", "silver", "referential_integrity_customer_id", zero, int_text("orphans"),
            zero_rule("orphans", "WARN"), text_sql("referential_integrity_customer_id.details", n=int_text("orphans"))),
        row("retail_orders", "silver", "anomaly_zero_revenue_months", zero, int_text("zero_rev_months"),
            zero_rule("zero_rev_months", "FAIL"), text_sql("anomaly_zero_revenue_months.details")),
        row("retail_orders", "silver", "anomaly_monthly_revenue_deviation",
            text_sql("anomaly_monthly_revenue_deviation.expected", mean=num_text("mean_revenue")),
            int_text("anomalous_months"), zero_rule("anomalous_months", "WARN"),
            f"CASE WHEN anomalous_months > 0 THEN "
            f"{text_sql('anomaly_monthly_revenue_deviation.details', months='anomalous_list')} "
            f"ELSE {text_sql('anomaly_monthly_revenue_deviation.details.none')} END"),
    ]
    return ctes + "\nUNION ALL\n".join(rows)


def gold_checks_sql() -> str:
    rep = _reports(GOLD_LINES)

    def nested(name: str, key: str) -> str:
        return f"{name} AS ({rep[key]}\n)"

    ctes = with_(
        GOLD_LINES, DIM_DATE, DIM_PRODUCT, dim_customer_cte(),
        nested("r_yearly", "revenue_yearly"), nested("r_monthly", "revenue_monthly"),
        nested("r_aov", "aov_monthly"), nested("r_clv", "customer_lifetime_value"),
        nested("r_ret", "retention_rate"), nested("r_basket", "basket_size_monthly"),
        nested("r_nvr", "new_vs_returning"),
    ) + """,
s AS (SELECT
  (SELECT count(*) FROM silver_orders) AS silver_count,
  (SELECT count(*) FROM sales_lines) AS fact_count,
""" + ",\n".join(
        f"  (SELECT count(*) FROM sales_lines WHERE {k} IS NULL) AS null_f_{k}" for k in dq.FACT_KEY_COLUMNS
    ) + """,
  (SELECT count(*) FROM sales_lines WHERE NOT is_cancelled) AS created_count,
  (SELECT count(*) FROM sales_lines WHERE is_cancelled) AS cancelled_count,
  (SELECT count(*) FROM sales_lines WHERE total_amount < 0) AS neg_amount,
  (SELECT count(*) FROM sales_lines WHERE quantity < 0) AS neg_qty,
  (SELECT """ + mtotal("total_amount") + """ FROM sales_lines WHERE NOT is_cancelled) AS fact_revenue,
  (SELECT count(*) FROM (SELECT DISTINCT date_key FROM sales_lines) f
     WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = f.date_key)) AS orphan_dates,
  (SELECT count(*) FROM (SELECT DISTINCT stock_code FROM sales_lines) f
     WHERE NOT EXISTS (SELECT 1 FROM dim_product d WHERE d.stock_code = f.stock_code)) AS orphan_products,
  (SELECT count(*) FROM (SELECT 1 FROM dim_product GROUP BY stock_code HAVING count(*) > 1)) AS product_dupes,
  (SELECT count(*) FROM dim_product WHERE description IS NULL) AS null_desc,
  (SELECT count(*) FROM (SELECT 1 FROM dim_customer GROUP BY customer_id HAVING count(*) > 1)) AS customer_dupes,
  (SELECT count(*) FROM dim_customer) AS dim_customer_count,
  (SELECT min(full_date) FROM dim_date) AS min_date,
  (SELECT max(full_date) FROM dim_date) AS max_date,
  (SELECT """ + mtotal("total_revenue") + """ FROM r_yearly) AS yearly_revenue,
  (SELECT count(*) FROM r_monthly WHERE total_revenue <= 0) AS zero_rev_months,
  (SELECT count(*) FROM r_monthly WHERE mom_change_pct > 200 OR mom_change_pct < -80) AS extreme_mom,
  (SELECT min(avg_order_value) FROM r_aov) AS min_aov,
  (SELECT count(*) FROM r_clv WHERE lifetime_revenue < 0) AS neg_clv,
  (SELECT count(*) FROM r_clv) AS clv_count,
  (SELECT count(*) FROM r_ret WHERE retention_rate_pct < 0 OR retention_rate_pct > 100) AS bad_retention,
  (SELECT min(avg_basket_size) FROM r_basket) AS min_basket,
  (SELECT count(*) FROM (SELECT DISTINCT year, month FROM r_nvr)) AS months_total,
  (SELECT count(*) FROM (SELECT DISTINCT year, month FROM r_nvr WHERE customer_type = 'new')) AS months_with_new
)
"""
    fo = "fact_order_items"
    zero = text_sql("zero.expected")

    def count_row(table: str, name: str, scalar: str, bad: str, **slots: str) -> str:
        return row(table, "gold", name, zero, int_text(scalar), zero_rule(scalar, bad),
                   text_sql(f"{name}.details", **slots))

    rows = [
        row(fo, "gold", "row_count_vs_silver", int_text("silver_count"), int_text("fact_count"),
            "CASE WHEN fact_count = silver_count THEN 'PASS' ELSE 'FAIL' END",
            text_sql("row_count_vs_silver.details", n=int_text("abs(fact_count - silver_count)"))),
    ]
    for k in dq.FACT_KEY_COLUMNS:
        n = f"null_f_{k}"
        rows.append(row(fo, "gold", f"null_check_{k}", zero, int_text(n), zero_rule(n, "FAIL"),
                        text_sql("null_check_key.details", n=int_text(n), column=lit(k))))
    rows += [
        row(fo, "gold", "event_split_created", text_sql("event_split.expected"), int_text("created_count"),
            "CASE WHEN created_count > 0 THEN 'PASS' ELSE 'FAIL' END", text_sql("event_split_created.details")),
        row(fo, "gold", "event_split_cancelled", text_sql("event_split.expected"), int_text("cancelled_count"),
            "CASE WHEN cancelled_count > 0 THEN 'PASS' ELSE 'FAIL' END", text_sql("event_split_cancelled.details")),
        count_row(fo, "no_negative_total_amount", "neg_amount", "FAIL"),
        count_row(fo, "no_negative_quantity", "neg_qty", "FAIL"),
        count_row(fo, "referential_integrity_date_key", "orphan_dates", "FAIL", n=int_text("orphan_dates")),
        count_row(fo, "referential_integrity_stock_code", "orphan_products", "FAIL", n=int_text("orphan_products")),
        count_row("dim_product", "duplicate_stock_codes", "product_dupes", "FAIL"),
        count_row("dim_product", "null_descriptions", "null_desc", "WARN", n=int_text("null_desc")),
        count_row("dim_customer", "duplicate_customer_ids", "customer_dupes", "FAIL"),
        row("dim_date", "gold", "date_range_min", lit(dq.DATE_RANGE_MIN), int_text("min_date"),
            f"CASE WHEN CAST(min_date AS VARCHAR) <= {lit(dq.DATE_RANGE_MIN)} THEN 'PASS' ELSE 'WARN' END",
            text_sql("date_range_min.details")),
        row("dim_date", "gold", "date_range_max", lit(dq.DATE_RANGE_MAX_EXPECTED), int_text("max_date"),
            f"CASE WHEN CAST(max_date AS VARCHAR) >= {lit(dq.DATE_RANGE_MAX_REQUIRED)} THEN 'PASS' ELSE 'WARN' END",
            text_sql("date_range_max.details")),
        row("revenue_yearly", "gold", "revenue_reconciliation_vs_fact", num_text("fact_revenue"),
            num_text("yearly_revenue"),
            "CASE WHEN abs(fact_revenue - yearly_revenue) < 1 THEN 'PASS' ELSE 'FAIL' END",
            text_sql("revenue_reconciliation_vs_fact.details",
                     diff="CAST(CAST(abs(fact_revenue - yearly_revenue) AS DECIMAL(38,2)) AS VARCHAR)")),
        count_row("revenue_monthly", "no_zero_revenue_months", "zero_rev_months", "FAIL",
                  n=int_text("zero_rev_months")),
        row("revenue_monthly", "gold", "extreme_mom_change", zero, int_text("extreme_mom"),
            "CASE WHEN extreme_mom > 0 THEN 'WARN' ELSE 'PASS' END",
            text_sql("extreme_mom_change.details", n=int_text("extreme_mom"))),
        row("aov_monthly", "gold", "aov_positive", text_sql("aov_positive.expected"), num_text("min_aov"),
            "CASE WHEN min_aov > 0 THEN 'PASS' ELSE 'FAIL' END",
            text_sql("aov_positive.details", min=num_text("min_aov"))),
        count_row("customer_lifetime_value", "no_negative_clv", "neg_clv", "FAIL", n=int_text("neg_clv")),
        row("customer_lifetime_value", "gold", "clv_customer_count", int_text("dim_customer_count + 1"),
            int_text("clv_count"), "CASE WHEN clv_count = dim_customer_count + 1 THEN 'PASS' ELSE 'WARN' END",
            text_sql("clv_customer_count.details", n=int_text("dim_customer_count"),
                     expected=int_text("dim_customer_count + 1"))),
        row("retention_rate", "gold", "retention_rate_bounds", text_sql("retention_rate_bounds.expected"),
            text_sql("retention_rate_bounds.actual", n=int_text("bad_retention")),
            zero_rule("bad_retention", "FAIL"), text_sql("retention_rate_bounds.details")),
        row("basket_size_monthly", "gold", "basket_size_min", text_sql("basket_size_min.expected"),
            num_text("min_basket"), "CASE WHEN min_basket >= 1 THEN 'PASS' ELSE 'FAIL' END",
            text_sql("basket_size_min.details", min=num_text("min_basket"))),
        row("new_vs_returning", "gold", "new_customers_every_month", int_text("months_total"),
            int_text("months_with_new"), "CASE WHEN months_total = months_with_new THEN 'PASS' ELSE 'WARN' END",
            text_sql("new_customers_every_month.details", n=int_text("months_total - months_with_new"))),
    ]
    return ctes + "\nUNION ALL\n".join(rows)


def quality_sql() -> dict[str, str]:
    silver, gold = silver_checks_sql(), gold_checks_sql()
    summary = (
        f"SELECT status, count(*) AS checks FROM (SELECT status FROM ({silver}) "
        f"UNION ALL SELECT status FROM ({gold})) GROUP BY status"
    )
    orphans = with_(SALES_LINES, ORDER_EVENTS, SILVER_ORDERS, dim_customer_cte(), CUSTOMER_EVENTS) + """
SELECT invoice_id, stock_code, customer_id, event_time, quantity FROM silver_orders o
WHERE customer_id IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM customer_events c WHERE CAST(c.customer_id AS VARCHAR) = CAST(o.customer_id AS VARCHAR))"""
    return {"dq_silver_checks": silver, "dq_gold_checks": gold, "dq_summary": summary, "dq_orphan_orders": orphans}
