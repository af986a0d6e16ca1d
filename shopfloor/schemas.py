"""Declared schemas: event payloads, bronze envelope, raw sales lines, metrics."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw sales line (8 columns).  Column names as in the source spreadsheet.
RAW_SALES = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),  # wall-clock time, no zone
        T.StructField("Price", T.DoubleType()),
        T.StructField("Customer ID", T.LongType()),
        T.StructField("Country", T.StringType()),
    ]
)

# Order event payload (11 fields).  customer_id is a JSON number in the
# payload (read as long: customer keys outgrow int at scale) and becomes a
# string from the fact table onward.
ORDER_EVENT = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("invoice_id", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("country", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("ingestion_time", T.StringType()),
    ]
)

# Customer event payload (4 fields read by silver; producers may add more).
CUSTOMER_EVENT = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("first_seen_time", T.StringType()),
    ]
)

# Stream record as a Kafka source delivers it.
KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Bronze envelope: raw JSON plus transport metadata, schema-on-read.
BRONZE_ENVELOPE = T.StructType(
    [
        T.StructField("kafka_key", T.StringType()),
        T.StructField("raw_json", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("bronze_ingestion_time", T.TimestampType()),
    ]
)

ENVELOPE_COLUMNS = [f.name for f in BRONZE_ENVELOPE.fields if f.name != "raw_json"]

# One data-quality check result.
METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_timestamp", T.TimestampType(), False),
        T.StructField("pipeline", T.StringType(), False),
        T.StructField("layer", T.StringType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("expected", T.StringType(), True),
        T.StructField("actual", T.StringType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("details", T.StringType(), True),
    ]
)

# Fact columns in output order.
FACT_COLUMNS = [
    "invoice_id",
    "stock_code",
    "customer_id",
    "country",
    "date_key",
    "year",
    "month",
    "quantity",
    "unit_price",
    "total_amount",
    "is_cancelled",
    "event_time",
    "kafka_timestamp",
    "bronze_ingestion_time",
    "silver_ingestion_time",
]
