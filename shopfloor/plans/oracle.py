"""Equivalent ANSI SQL (DuckDB dialect) for the registered queries.

The SQL is an independent statement of each query's meaning over the same
Parquet views, used as the correctness oracle.  Money sums are exact
decimals; averages and percentages use the same half-away-from-zero integer
rounding as ``shopfloor.functions.money`` so both engines agree to the bit.
"""

from __future__ import annotations

from shopfloor.sources.adapter import CANCEL_FLAG, GUEST_MODULUS, MISSING_DESCRIPTION_MODULUS

ADAPTER_SELECT = f"""
  SELECT CAST(l.l_orderkey AS VARCHAR) AS invoice_id,
         p.p_brand AS stock_code,
         CASE WHEN l.l_partkey % {MISSING_DESCRIPTION_MODULUS} = 0 THEN NULL ELSE p.p_name END AS description,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         p.p_retailprice AS unit_price,
         l.l_extendedprice AS total_amount,
         n.n_name AS country,
         CASE WHEN o.o_custkey % {GUEST_MODULUS} = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS customer_id,
         o.o_orderdate AS event_time,
         l.l_returnflag = '{CANCEL_FLAG}' AS is_cancelled,
         CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(month(o.o_orderdate) AS INTEGER) AS month,
         l.l_linenumber AS line_number
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

SALES_LINES = f"""
sales_lines AS ({ADAPTER_SELECT}
),
sales AS (SELECT * FROM sales_lines WHERE NOT is_cancelled)"""

DIM_DATE = """
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
         d AS full_date,
         CAST(dayofmonth(d) AS INTEGER) AS day,
         CAST(month(d) AS INTEGER) AS month,
         CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(year(d) AS INTEGER) AS year,
         strftime(d, '%A') AS day_of_week,
         dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(mn, mx, INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT min(CAST(event_time AS DATE)) AS mn, max(CAST(event_time AS DATE)) AS mx FROM sales_lines)
        WHERE mn IS NOT NULL)
)"""

DIM_PRODUCT = """
dim_product AS (
  SELECT stock_code, description FROM (
    SELECT stock_code, description,
           row_number() OVER (PARTITION BY stock_code ORDER BY count(*) DESC, description ASC) AS rn
    FROM sales_lines WHERE description IS NOT NULL
    GROUP BY stock_code, description)
  WHERE rn = 1
)"""


def dim_customer_cte(cohort_years=None) -> str:
    if cohort_years is None:
        cohort = "CASE WHEN fy IS NOT NULL THEN 'cohort_' || CAST(fy AS VARCHAR) ELSE 'unknown' END"
    else:
        arms = " ".join(f"WHEN fy = {y} THEN 'cohort_{y}'" for y in cohort_years)
        cohort = f"CASE {arms} ELSE 'unknown' END"
    return f"""
customers_first AS (
  SELECT customer_id, country, first_seen_time FROM (
    SELECT customer_id, country, event_time AS first_seen_time,
           row_number() OVER (PARTITION BY customer_id
                              ORDER BY event_time IS NULL, event_time, country NULLS FIRST) AS rn
    FROM sales_lines WHERE customer_id IS NOT NULL)
  WHERE rn = 1
),
dim_customer AS (
  SELECT customer_id, country, first_seen_time, fy AS first_seen_year, {cohort} AS cohort
  FROM (SELECT *, CAST(year(first_seen_time) AS INTEGER) AS fy FROM customers_first)
)"""


def msum(x: str) -> str:
    """Exact money sum, unrounded: each double as the shortest decimal that denotes it."""
    return f"SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)))"


def cents(x: str) -> str:
    return f"CAST(round({x}, 2) AS DECIMAL(38,2))"


def mtotal(x: str) -> str:
    """Exact money sum, rounded once."""
    return cents(msum(x))


def money_units(x: str) -> str:
    """An exact amount as a whole number of 10**-18."""
    return f"CAST(replace(CAST(CAST({x} AS DECIMAL(38,18)) AS VARCHAR), '.', '') AS HUGEINT)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def ratio(num: str, den: str, scale: int = 2, num_scale: int = 0, den_scale: int = 0, factor: int = 1) -> str:
    """round(factor * num / den, scale), half away from zero, exact; null on 0."""
    shift = scale + den_scale - num_scale
    x = f"(CAST(({num}) * {10**num_scale} AS HUGEINT) * {factor * 10**shift})"
    d = f"CAST(({den}) * {10**den_scale} AS HUGEINT)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE "
        f"CAST(sign({x}) * sign({d}) * ((2 * abs({x}) + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {float(10**scale)} END)"
    )


def money_ratio(num: str, den: str) -> str:
    """An exact amount by a count, rounded to 2 decimals, half away from zero; null on 0."""
    x, d = money_units(num), f"(CAST({den} AS HUGEINT) * {10**16})"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE "
        f"CAST(sign({x}) * ((2 * abs({x}) + {d}) // (2 * {d})) AS DOUBLE) / 100.0 END)"
    )


def pct_change(curr: str, prev: str, value_scale: int = 0) -> str:
    if value_scale:
        curr = f"CAST({curr} AS DECIMAL(38,{value_scale}))"
        prev = f"CAST({prev} AS DECIMAL(38,{value_scale}))"
    return ratio(f"({curr}) - ({prev})", prev, num_scale=value_scale, den_scale=value_scale, factor=100)


def ym(y: str = "year", m: str = "month") -> str:
    return f"(CAST({y} AS VARCHAR) || '-' || lpad(CAST({m} AS VARCHAR), 2, '0'))"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


RLU = (
    f"{dbl(mtotal('total_amount'))} AS total_revenue, count(invoice_id) AS total_line_items, "
    "CAST(sum(quantity) AS BIGINT) AS total_units_sold"
)


def _reports(lines: str = SALES_LINES) -> dict[str, str]:
    base = with_(lines)
    q: dict[str, str] = {}
    q["dim_date"] = with_(lines, DIM_DATE) + " SELECT * FROM dim_date"
    q["dim_product"] = with_(lines, DIM_PRODUCT) + " SELECT * FROM dim_product"
    q["dim_customer"] = with_(lines, dim_customer_cte()) + " SELECT * FROM dim_customer"
    q["dim_geography"] = base + " SELECT DISTINCT country FROM sales_lines WHERE country IS NOT NULL"
    q["fact_order_items"] = base + (
        " SELECT invoice_id, stock_code, customer_id, country, date_key, year, month, quantity,"
        " unit_price, total_amount, is_cancelled, event_time FROM sales_lines"
    )
    q["revenue_daily"] = with_(lines, DIM_DATE) + f"""
SELECT d.full_date, s.year, s.month, d.day, d.day_of_week, d.is_weekend, {RLU}
FROM sales s JOIN dim_date d ON s.date_key = d.date_key
GROUP BY d.full_date, s.year, s.month, d.day, d.day_of_week, d.is_weekend"""
    q["revenue_monthly"] = base + f""",
m AS (SELECT year, month, {mtotal('total_amount')} AS rev, count(invoice_id) AS total_line_items,
             CAST(sum(quantity) AS BIGINT) AS total_units_sold FROM sales GROUP BY year, month),
l AS (SELECT *, lag(rev) OVER (ORDER BY year, month) AS prev FROM m)
SELECT year, month, {dbl('rev')} AS total_revenue, total_line_items, total_units_sold, {ym()} AS year_month,
       {dbl('prev')} AS prev_month_revenue, {pct_change('rev', 'prev', 2)} AS mom_change_pct
FROM l"""
    q["revenue_yearly"] = base + f" SELECT year, {RLU} FROM sales GROUP BY year"
    prod = f"""
SELECT {{keys}}, p.description, {dbl('rev')} AS total_revenue, total_units_sold, total_line_items{{extra}}
FROM (SELECT {{keys}}, {mtotal('total_amount')} AS rev, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
             count(invoice_id) AS total_line_items FROM sales GROUP BY {{keys}}) a
LEFT JOIN dim_product p USING (stock_code)"""
    q["top_products_by_country"] = with_(lines, DIM_PRODUCT) + """
SELECT * FROM (""" + prod.format(
        keys="country, stock_code",
        extra=", CAST(dense_rank() OVER (PARTITION BY country ORDER BY rev DESC) AS INTEGER) AS country_rank",
    ) + ") WHERE country_rank <= 20"
    q["top_products_global"] = with_(lines, DIM_PRODUCT) + prod.format(
        keys="stock_code",
        extra=", CAST(dense_rank() OVER (ORDER BY rev DESC) AS INTEGER) AS revenue_rank"
        ", CAST(dense_rank() OVER (ORDER BY total_units_sold DESC) AS INTEGER) AS units_rank",
    )
    aov = (
        f"{money_ratio('sum(invoice_revenue)', 'count(invoice_revenue)')} AS avg_order_value, "
        f"count(invoice_id) AS total_invoices, {dbl(cents('sum(invoice_revenue)'))} AS total_revenue"
    )
    q["aov_monthly"] = base + f"""
SELECT year, month, {aov}, {ym()} AS year_month
FROM (SELECT year, month, invoice_id, {msum('total_amount')} AS invoice_revenue
      FROM sales GROUP BY year, month, invoice_id) GROUP BY year, month"""
    q["aov_overall"] = base + f"""
SELECT {aov} FROM (SELECT invoice_id, {msum('total_amount')} AS invoice_revenue FROM sales GROUP BY invoice_id)"""
    q["revenue_by_country_month"] = base + f"""
SELECT country, year, month, {RLU}, {ym()} AS year_month FROM sales GROUP BY country, year, month"""
    q["revenue_by_country_year"] = base + f" SELECT country, year, {RLU} FROM sales GROUP BY country, year"
    q["product_demand_trends"] = with_(lines, DIM_PRODUCT) + f""",
a AS (SELECT stock_code, year, month, CAST(sum(quantity) AS BIGINT) AS units_sold,
             {mtotal('total_amount')} AS rev, count(invoice_id) AS order_line_count
      FROM sales GROUP BY stock_code, year, month),
l AS (SELECT a.*, p.description,
             lag(units_sold) OVER (PARTITION BY stock_code ORDER BY year, month) AS prev_month_units
      FROM a LEFT JOIN dim_product p USING (stock_code))
SELECT stock_code, description, year, month, units_sold, {dbl('rev')} AS revenue, order_line_count,
       {ym()} AS year_month, prev_month_units,
       {pct_change('units_sold', 'prev_month_units')} AS mom_units_change_pct
FROM l"""
    active = """
active AS (SELECT DISTINCT customer_id, year, month, year * 12 + month AS period
           FROM sales WHERE customer_id IS NOT NULL)"""
    q["new_vs_returning"] = with_(lines, active) + f""",
firsts AS (SELECT customer_id, min(period) AS first_period FROM active GROUP BY customer_id)
SELECT year, month, customer_type, count(customer_id) AS customer_count, {ym()} AS year_month
FROM (SELECT a.year, a.month, a.customer_id,
             CASE WHEN a.period = f.first_period THEN 'new' ELSE 'returning' END AS customer_type
      FROM active a JOIN firsts f USING (customer_id))
GROUP BY year, month, customer_type"""
    q["customer_lifetime_value"] = base + f""",
c AS (SELECT coalesce(customer_id, 'guest') AS customer_id_clean, {mtotal('total_amount')} AS rev,
             count(DISTINCT invoice_id) AS total_orders,
             {money_ratio(msum('total_amount'), 'count(total_amount)')} AS avg_line_item_value,
             CAST(sum(quantity) AS BIGINT) AS total_units_purchased,
             min(event_time) AS first_order_date, max(event_time) AS last_order_date
      FROM sales GROUP BY 1)
SELECT customer_id_clean, {dbl('rev')} AS lifetime_revenue, total_orders, avg_line_item_value,
       total_units_purchased, first_order_date, last_order_date,
       {money_ratio('rev', 'total_orders')} AS avg_order_value,
       CAST(dense_rank() OVER (ORDER BY rev DESC) AS INTEGER) AS clv_rank
FROM c"""
    q["customers_per_country"] = with_(lines, dim_customer_cte()) + f""",
h AS (SELECT country, count(customer_id) AS total_customers FROM dim_customer GROUP BY country),
r AS (SELECT country, {mtotal('total_amount')} AS rev FROM sales WHERE customer_id IS NOT NULL GROUP BY country)
SELECT h.country, h.total_customers, {dbl('r.rev')} AS total_revenue,
       {money_ratio('r.rev', 'h.total_customers')} AS revenue_per_customer
FROM h LEFT JOIN r ON h.country = r.country"""
    q["top_customers_by_orders"] = with_(lines, dim_customer_cte()) + f""",
a AS (SELECT customer_id, count(DISTINCT invoice_id) AS total_orders,
             {dbl(mtotal('total_amount'))} AS total_revenue,
             min(event_time) AS first_order_date, max(event_time) AS last_order_date
      FROM sales WHERE customer_id IS NOT NULL GROUP BY customer_id)
SELECT a.customer_id, total_orders, total_revenue, first_order_date, last_order_date, d.country, d.cohort,
       CAST(dense_rank() OVER (ORDER BY total_orders DESC) AS INTEGER) AS order_rank
FROM a LEFT JOIN dim_customer d ON a.customer_id = d.customer_id"""
    q["retention_rate"] = with_(lines, active) + f""",
r AS (SELECT c.year, c.month, count(c.customer_id) AS active_customers,
             count(n.customer_id) AS retained_next_month
      FROM active c LEFT JOIN active n ON c.customer_id = n.customer_id AND n.period = c.period + 1
      GROUP BY c.year, c.month)
SELECT year, month, active_customers, retained_next_month,
       {ratio('retained_next_month', 'active_customers', factor=100)} AS retention_rate_pct, {ym()} AS year_month
FROM r"""
    basket = f"""
b AS (SELECT invoice_id, year, month, count(stock_code) AS line_item_count,
             CAST(sum(quantity) AS BIGINT) AS total_units, {msum('total_amount')} AS basket_value
      FROM sales GROUP BY invoice_id, year, month)"""
    bagg = (
        f"{ratio('sum(line_item_count)', 'count(line_item_count)')} AS avg_basket_size, "
        f"{ratio('sum(total_units)', 'count(total_units)')} AS avg_units_per_order, "
        f"{money_ratio('sum(basket_value)', 'count(basket_value)')} AS avg_basket_value, "
        "count(invoice_id) AS total_invoices"
    )
    q["basket_size_monthly"] = with_(lines, basket) + f"""
SELECT year, month, {bagg}, {ym()} AS year_month FROM b GROUP BY year, month"""
    q["basket_size_overall"] = with_(lines, basket) + f" SELECT {bagg} FROM b"
    return q


def order_events_cte(src: str = "sales_lines") -> str:
    return f"""
order_events AS (
  SELECT CASE WHEN is_cancelled THEN 'order_item_cancelled' ELSE 'order_item_created' END AS event_type,
         invoice_id, stock_code, description, quantity, unit_price, country,
         CAST(customer_id AS BIGINT) AS customer_id,
         strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time,
         CAST(quantity AS DOUBLE) * unit_price AS total_amount,
         line_number
  FROM {src} WHERE quantity <> 0
)"""


ORDER_EVENTS = order_events_cte()

# Silver orders: replayed envelope, typed, nulls filled, first arrival per
# 4-key (arrival = time, partition, offset; then the remaining columns).
SILVER_ORDERS = """
silver_in AS (
  SELECT invoice_id AS kafka_key, 'retail_order_events' AS topic, 0 AS partition,
         CAST(line_number AS BIGINT) AS "offset", CAST(event_time AS TIMESTAMP) AS kafka_timestamp,
         event_type, invoice_id, stock_code, description, coalesce(quantity, 0) AS quantity,
         coalesce(unit_price, 0.0) AS unit_price, country, customer_id,
         CAST(event_time AS TIMESTAMP) AS event_time, coalesce(total_amount, 0.0) AS total_amount
  FROM order_events WHERE event_time IS NOT NULL
),
silver_orders AS (
  SELECT * EXCLUDE (rn, kafka_timestamp), CAST(year(event_time) AS INTEGER) AS year,
         CAST(month(event_time) AS INTEGER) AS month
  FROM (SELECT *, row_number() OVER (
          PARTITION BY invoice_id, stock_code, quantity, event_time
          ORDER BY kafka_timestamp NULLS FIRST, partition NULLS FIRST, "offset" NULLS FIRST,
                   kafka_key NULLS FIRST, topic NULLS FIRST, event_type NULLS FIRST, description NULLS FIRST,
                   unit_price NULLS FIRST, country NULLS FIRST, customer_id NULLS FIRST,
                   total_amount NULLS FIRST) AS rn
        FROM silver_in)
  WHERE rn = 1
),
silver_fact AS (
  SELECT invoice_id, stock_code, CAST(customer_id AS VARCHAR) AS customer_id, country,
         CAST(strftime(event_time, '%Y%m%d') AS INTEGER) AS date_key, year, month,
         abs(quantity) AS quantity, unit_price, abs(total_amount) AS total_amount,
         coalesce(event_type = 'order_item_cancelled', false) AS is_cancelled, event_time
  FROM silver_orders
)"""

CUSTOMER_EVENTS = """
customer_events AS (
  SELECT 'customer_activity' AS event_type, CAST(customer_id AS BIGINT) AS customer_id, country,
         strftime(first_seen_time, '%Y-%m-%d %H:%M:%S') AS first_seen_time
  FROM customers_first
)"""


# Gold built from silver: the report SQL runs over lines derived from the
# de-duplicated silver orders (amount = quantity * price, as the events say).
GOLD_LINES = f"""
src_lines AS ({ADAPTER_SELECT}
),""" + order_events_cte("src_lines") + "," + SILVER_ORDERS + """,
sales_lines AS (
  SELECT invoice_id, stock_code, description, quantity, unit_price, total_amount, country,
         CAST(customer_id AS VARCHAR) AS customer_id, event_time,
         coalesce(event_type = 'order_item_cancelled', false) AS is_cancelled,
         CAST(strftime(event_time, '%Y%m%d') AS INTEGER) AS date_key, year, month
  FROM silver_orders
),
sales AS (SELECT * FROM sales_lines WHERE NOT is_cancelled)"""


def _events() -> dict[str, str]:
    q: dict[str, str] = {}
    ev_cols = ("event_type, invoice_id, stock_code, description, quantity, unit_price, country, customer_id, "
               "event_time, total_amount")
    q["order_events"] = with_(SALES_LINES, ORDER_EVENTS) + f" SELECT {ev_cols} FROM order_events"
    q["order_event_records"] = q["order_events"]
    q["customer_events"] = with_(SALES_LINES, dim_customer_cte(), CUSTOMER_EVENTS) + " SELECT * FROM customer_events"
    q["silver_orders"] = with_(SALES_LINES, ORDER_EVENTS, SILVER_ORDERS) + " SELECT * FROM silver_orders"
    q["silver_customers"] = with_(SALES_LINES, dim_customer_cte(), CUSTOMER_EVENTS) + """
SELECT CAST(customer_id AS VARCHAR) AS kafka_key, 'retail_customer_events' AS topic, event_type,
       CAST(customer_id AS VARCHAR) AS customer_id, country, CAST(first_seen_time AS TIMESTAMP) AS first_seen_time
FROM customer_events"""
    q["silver_fact_order_items"] = with_(SALES_LINES, ORDER_EVENTS, SILVER_ORDERS) + " SELECT * FROM silver_fact"
    q["revenue_monthly_from_events"] = with_(SALES_LINES, ORDER_EVENTS, SILVER_ORDERS) + f""",
m AS (SELECT year, month, {mtotal('total_amount')} AS rev, count(invoice_id) AS total_line_items,
             CAST(sum(quantity) AS BIGINT) AS total_units_sold
      FROM silver_fact WHERE NOT is_cancelled GROUP BY year, month),
l AS (SELECT *, lag(rev) OVER (ORDER BY year, month) AS prev FROM m)
SELECT year, month, {dbl('rev')} AS total_revenue, total_line_items, total_units_sold, {ym()} AS year_month,
       {dbl('prev')} AS prev_month_revenue, {pct_change('rev', 'prev', 2)} AS mom_change_pct
FROM l"""
    return q


def oracle_sql() -> dict[str, str]:
    from shopfloor.plans.oracle_profile import profile_sql
    from shopfloor.plans.oracle_quality import quality_sql

    from shopfloor.plans.oracle_serving import serving_sql

    return {**_reports(), **_events(), **quality_sql(), **profile_sql(), **serving_sql()}
