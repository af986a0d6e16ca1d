"""Event contract: raw sales lines -> order and customer events.

The original producer walked the spreadsheet row by row in invoice-date
order.  Here the same contract is one Spark job over the whole table:

* quantity > 0 -> ``order_item_created`` with ``total_amount = qty * price``
* quantity < 0 -> ``order_item_cancelled`` with ``abs(qty)`` and
  ``abs(qty) * price``
* quantity = 0 (or null) -> no order event
* each identified customer -> one ``customer_activity`` event at its first
  line (zero-quantity lines count), with that line's country.  "First" is
  found with a grouped ``min`` over (time, country), which pre-aggregates on
  the map side, so a customer with a third of all lines costs one row per
  task, not a third of the table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.json import to_json_record

# Topic names, event type names and the payload time format.
ORDER_TOPIC = "retail_order_events"
CUSTOMER_TOPIC = "retail_customer_events"
ORDER_CREATED = "order_item_created"
ORDER_CANCELLED = "order_item_cancelled"
CUSTOMER_ACTIVITY = "customer_activity"
ORDER_EVENT_TYPES = (ORDER_CREATED, ORDER_CANCELLED)
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

ORDER_FIELDS = [
    "event_type", "invoice_id", "stock_code", "description", "quantity", "unit_price",
    "country", "customer_id", "event_time", "total_amount", "ingestion_time",
]
CUSTOMER_FIELDS = ["event_type", "customer_id", "country", "first_seen_time", "ingestion_time"]


def _ingestion_text(ingestion_time: Column | None) -> Column:
    ts = F.current_timestamp() if ingestion_time is None else ingestion_time
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def order_events(raw: DataFrame, ingestion_time: Column | None = None) -> DataFrame:
    """One order event per raw line with a non-zero quantity."""
    q = F.col("Quantity")
    qty = F.abs(q).cast("int")
    return raw.filter(q != 0).select(
        F.when(q > 0, F.lit(ORDER_CREATED)).otherwise(F.lit(ORDER_CANCELLED)).alias("event_type"),
        F.col("Invoice").cast("string").alias("invoice_id"),
        F.col("StockCode").cast("string").alias("stock_code"),
        F.col("Description").alias("description"),
        qty.alias("quantity"),
        F.col("Price").cast("double").alias("unit_price"),
        F.col("Country").alias("country"),
        F.col("Customer ID").cast("long").alias("customer_id"),
        F.date_format("InvoiceDate", EVENT_TIME_FORMAT).alias("event_time"),
        (qty * F.col("Price").cast("double")).alias("total_amount"),
        _ingestion_text(ingestion_time).alias("ingestion_time"),
        *([F.col("LineNumber").alias("line_number")] if "LineNumber" in raw.columns else []),
    )


def customer_events(raw: DataFrame, ingestion_time: Column | None = None) -> DataFrame:
    """One ``customer_activity`` event per identified customer at its first
    line (earliest invoice date; ties: smallest country)."""
    # struct order: known dates before unknown ones, then date, then country
    first = F.min(F.struct(F.col("InvoiceDate").isNull(), F.col("InvoiceDate"), F.col("Country")))
    per = (
        raw.filter(F.col("Customer ID").isNotNull())
        .groupBy(F.col("Customer ID").alias("customer_id"))
        .agg(first.alias("__f"))
    )
    return per.select(
        F.lit(CUSTOMER_ACTIVITY).alias("event_type"),
        F.col("customer_id").cast("long").alias("customer_id"),
        F.col("__f.Country").alias("country"),
        F.date_format("__f.InvoiceDate", EVENT_TIME_FORMAT).alias("first_seen_time"),
        _ingestion_text(ingestion_time).alias("ingestion_time"),
    )


def order_records(events: DataFrame) -> DataFrame:
    """Order events as (key, value) records keyed by invoice; null fields are
    kept as JSON ``null``."""
    extra = [c for c in ("line_number",) if c in events.columns]
    return events.select(
        F.col("invoice_id").alias("key"),
        to_json_record(*ORDER_FIELDS).alias("value"),
        F.to_timestamp("event_time", EVENT_TIME_FORMAT).alias("event_ts"),
        *extra,
    )


def customer_records(events: DataFrame) -> DataFrame:
    """Customer events as (key, value) records keyed by customer id."""
    return events.select(
        F.col("customer_id").cast("string").alias("key"),
        to_json_record(*CUSTOMER_FIELDS).alias("value"),
        F.to_timestamp("first_seen_time", EVENT_TIME_FORMAT).alias("event_ts"),
    )


# Fields a pandas-based producer writes as a bare ``NaN`` when missing
# (``json.dumps`` of a float NaN), which is invalid JSON.
NAN_FIELDS = ("description", "unit_price", "total_amount")


def with_bare_nan(value: Column | str, fields=NAN_FIELDS) -> Column:
    """Re-serialise missing ``fields`` as bare ``NaN`` the way the original
    producer did, so the NaN repair can be exercised on derived data."""
    v = F.col(value) if isinstance(value, str) else value
    nan = F.regexp_replace(v, '"(' + "|".join(fields) + ')":null', '"$1":NaN')
    # Only a text with a null field can change: a substring test skips the regex engine for most rows.
    return F.when(v.contains('":null'), nan).otherwise(v)
