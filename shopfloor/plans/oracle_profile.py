"""DuckDB oracle for the profiling queries."""

from __future__ import annotations

from shopfloor.operators import profile as pro
from shopfloor.plans.oracle import ORDER_EVENTS, SALES_LINES, SILVER_ORDERS, money_units, ratio, with_

RAW = """
raw AS (
  SELECT invoice_id AS "Invoice", stock_code AS "StockCode", description AS "Description",
         CASE WHEN is_cancelled THEN -quantity ELSE quantity END AS "Quantity", event_time AS "InvoiceDate",
         unit_price AS "Price", CAST(customer_id AS BIGINT) AS "Customer ID", country AS "Country",
         line_number AS "LineNumber"
  FROM sales_lines
)"""

RAW8 = '"Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"'

# Events whose payload carries a bare NaN (missing description/price/amount).
NAN_EVENTS = "(description IS NULL OR unit_price IS NULL OR total_amount IS NULL)"

EVENTS_TOPIC = """
topic AS (SELECT CAST(pmod_user AS INTEGER) AS partition, CAST(event_id AS BIGINT) AS "offset"
          FROM (SELECT ((user_id % 4) + 4) % 4 AS pmod_user, event_id FROM events))"""


def profile_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    base = with_(SALES_LINES, RAW)
    cols = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]
    q["profile_null_counts"] = base + " SELECT " + ", ".join(
        f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in cols
    ) + " FROM raw"
    q["profile_event_type_counts"] = with_(SALES_LINES, ORDER_EVENTS) + (
        " SELECT event_type, count(*) AS count FROM order_events GROUP BY event_type"
    )
    parts = []
    for c in ("Quantity", "Price"):
        exact = f'sum(CAST(CAST(CAST("{c}" AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)))'
        x = f'CAST("{c}" AS DOUBLE)'
        parts.append(
            f"""SELECT '{c}' AS "column", count("{c}") AS count, CAST(0 AS BIGINT) AS left_out,
       CAST(sign({money_units(exact)}) * ((2 * abs({money_units(exact)}) + CAST(count("{c}") AS HUGEINT) * {10**14})
            // (2 * CAST(count("{c}") AS HUGEINT) * {10**14})) AS DOUBLE) / 10000.0 AS mean,
       round(stddev_samp({x}), 4) AS stddev, min({x}) AS min, quantile_cont({x}, 0.25) AS q1,
       quantile_cont({x}, 0.5) AS median, quantile_cont({x}, 0.75) AS q3, max({x}) AS max FROM raw"""
        )
    q["profile_describe"] = base + " " + " UNION ALL ".join(parts)
    q["profile_unreadable_json"] = with_(SALES_LINES, ORDER_EVENTS) + f"""
SELECT invoice_id AS kafka_key, 0 AS partition, CAST(line_number AS BIGINT) AS "offset"
FROM order_events WHERE {NAN_EVENTS}"""
    q["profile_nan_recovery"] = with_(SALES_LINES, ORDER_EVENTS) + f"""
SELECT event_type, count(*) AS recovered FROM order_events WHERE {NAN_EVENTS} GROUP BY event_type"""
    q["profile_offset_gaps"] = with_(EVENTS_TOPIC) + """
SELECT partition, prev_offset, "offset", "offset" - prev_offset AS gap
FROM (SELECT partition, "offset", lag("offset") OVER (PARTITION BY partition ORDER BY "offset") AS prev_offset
      FROM topic)
WHERE "offset" - prev_offset > 1"""
    q["profile_rows_per_topic_partition"] = with_(EVENTS_TOPIC) + (
        " SELECT partition, count(*) AS count FROM topic GROUP BY partition"
    )
    q["profile_duplicate_excess"] = with_(SALES_LINES, ORDER_EVENTS) + """,
ev AS (SELECT invoice_id, stock_code, CAST(event_time AS TIMESTAMP) AS event_time, quantity FROM order_events)
SELECT (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM ev
          GROUP BY invoice_id, stock_code, event_time HAVING count(*) > 1)) AS dup_rows_3key,
       (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM ev
          GROUP BY invoice_id, stock_code, event_time, quantity HAVING count(*) > 1)) AS dup_rows_4key"""
    pct = ratio("prev_rows - rows", "prev_rows", factor=100)
    q["profile_stage_funnel"] = with_(SALES_LINES, ORDER_EVENTS, SILVER_ORDERS) + f""",
c AS (SELECT 0 AS step, 'bronze' AS stage, (SELECT count(*) FROM order_events) AS rows
      UNION ALL SELECT 1, 'parsed', (SELECT count(event_type) FROM order_events)
      UNION ALL SELECT 2, 'event_time_present', (SELECT count(*) FROM order_events WHERE event_time IS NOT NULL)
      UNION ALL SELECT 3, 'deduplicated', (SELECT count(*) FROM silver_orders)),
l AS (SELECT *, lag(rows) OVER (ORDER BY step) AS prev_rows FROM c)
SELECT CAST(step AS INTEGER) AS step, stage, rows, prev_rows - rows AS dropped, {pct} AS dropped_pct,
       coalesce({pct} > {pro.FUNNEL_WARN_PCT}, false) AS warn
FROM l"""
    q["profile_descriptions_per_code"] = with_(SALES_LINES) + (
        " SELECT stock_code, count(DISTINCT description) AS n_descriptions FROM sales_lines GROUP BY stock_code"
    )
    q["profile_junk_description_codes"] = with_(SALES_LINES) + (
        " SELECT count(DISTINCT stock_code) AS junk_codes FROM sales_lines"
        f" WHERE regexp_matches(description, '{pro.junk_pattern()}')"
    )
    keys4 = '"Invoice", "StockCode", "InvoiceDate", "Quantity"'
    keys3 = '"Invoice", "StockCode", "InvoiceDate"'
    q["profile_duplicate_lines"] = base + f"""
SELECT {RAW8} FROM (SELECT *, count(*) OVER (PARTITION BY {keys4}) AS c FROM raw) WHERE c > 1"""
    q["profile_full_row_duplicates"] = base + f"""
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS full_row_duplicates
FROM (SELECT count(*) AS c FROM raw GROUP BY {RAW8})"""
    q["profile_conflicting_lines"] = base + f"""
SELECT {RAW8} FROM (SELECT *, count(*) OVER (PARTITION BY {keys3}) AS c3,
                           count(*) OVER (PARTITION BY {keys4}) AS c4 FROM raw)
WHERE c3 > 1 AND c4 = 1"""
    q["profile_sign_split"] = base + """
SELECT count(*) FILTER (WHERE "Quantity" > 0) AS positive_quantity,
       count(*) FILTER (WHERE "Quantity" < 0) AS negative_quantity,
       count(*) FILTER (WHERE "Quantity" = 0) AS zero_quantity,
       count(*) FILTER (WHERE "Price" < 0) AS negative_price,
       count(*) FILTER (WHERE "Price" = 0) AS zero_price FROM raw"""
    q["profile_first_seen_years"] = base + """
SELECT CAST(year(t) AS INTEGER) AS first_seen_year, count(*) AS customers
FROM (SELECT min("InvoiceDate") AS t FROM raw WHERE "Customer ID" IS NOT NULL GROUP BY "Customer ID")
GROUP BY 1"""
    q["profile_customer_counts"] = base + """
SELECT count(DISTINCT "Customer ID") AS distinct_customers,
       count(*) FILTER (WHERE "Customer ID" IS NULL) AS missing_customer_rows FROM raw"""
    q["profile_rows_per_year"] = base + (
        ' SELECT CAST(year("InvoiceDate") AS INTEGER) AS year, count(*) AS rows FROM raw GROUP BY 1'
    )
    q["profile_missing_customer_lines"] = with_(SALES_LINES, ORDER_EVENTS, SILVER_ORDERS) + """
SELECT count(*) FILTER (WHERE customer_id IS NULL OR trim(CAST(customer_id AS VARCHAR)) = '')
       AS lines_without_customer FROM silver_orders"""
    q["profile_invoice_lookup"] = base + """,
top AS (SELECT "Invoice" FROM raw GROUP BY "Invoice" ORDER BY count(*) DESC, "Invoice" LIMIT 1)
SELECT * FROM raw WHERE "Invoice" IN (SELECT "Invoice" FROM top)"""
    q["profile_description_totals"] = with_(SALES_LINES) + """
SELECT (SELECT count(*) FROM (SELECT DISTINCT stock_code FROM sales_lines)) AS codes,
       (SELECT count(*) FROM (SELECT 1 FROM sales_lines GROUP BY stock_code HAVING count(DISTINCT description) > 1))
           AS codes_with_several_descriptions,
       (SELECT count(*) FROM (SELECT DISTINCT stock_code, description FROM sales_lines)) AS distinct_pairs"""
    q["profile_files"] = "SELECT CAST(1 AS BIGINT) AS files, count(*) AS rows FROM lineitem"
    q["profile_country_lookup"] = base + f""" SELECT {RAW8} FROM raw WHERE "Country" = 'NATION_7'"""
    return q
