"""Silver layer: parsed, repaired, typed and de-duplicated events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.json import expand_once, parse, repair_nan
from shopfloor.operators.dedup import keep_first
from shopfloor.schemas import CUSTOMER_EVENT, ENVELOPE_COLUMNS, ORDER_EVENT

ORDER_KEYS = ("invoice_id", "stock_code", "quantity", "event_time")
CUSTOMER_KEYS = ("customer_id", "first_seen_time")
ARRIVAL_ORDER = ("kafka_timestamp", "partition", "offset")
ORDER_FILLS = {"quantity": 0, "unit_price": 0.0, "total_amount": 0.0}
CUSTOMER_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_orders(bronze: DataFrame, strict_nan: bool = False, typed: bool = False, keep=ENVELOPE_COLUMNS) -> DataFrame:
    """Repair bare NaN, parse the payload and flatten it next to the
    envelope.  Unreadable JSON gives null fields.  ``typed`` turns the two
    time fields into timestamps (null when unreadable).  The parse runs once
    per row even under later filters (``expand_once``).  ``keep``: the columns
    of ``bronze`` that stay beside the payload's."""
    flat = expand_once(bronze, list(keep), parse(repair_nan("raw_json", strict=strict_nan), ORDER_EVENT))
    if typed:
        flat = flat.withColumns({c: wall_clock(c) for c in ("event_time", "ingestion_time")})
    return flat


#: Text after a time of day that can only be a zone (``Z``, ``+05:00``, ``Europe/Paris``).
ZONED = r"\d:\d{1,2}(:\d{1,2}(\.\d*)?)?\s*[A-Za-z+-].*$"


def utc_wall_clock(instant: Column) -> Column:
    """The UTC wall-clock time of an instant, whatever the session time zone."""
    seconds = (F.unix_micros(instant).cast("decimal(18,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def wall_clock(text: Column | str, fmt: str | None = None) -> Column:
    """Event-time text -> ``timestamp_ntz``, null when unreadable: the time as the
    producer wrote it or, where the text names a zone, that instant's time in UTC.
    Unlike a zone-bound timestamp, the value, its date key and its month do not
    depend on the session time zone."""
    c = F.col(text) if isinstance(text, str) else text
    if fmt is None:
        return F.when(c.rlike(ZONED), utc_wall_clock(c.try_cast("timestamp"))).otherwise(c.try_cast("timestamp_ntz"))
    return F.when(F.try_to_timestamp(c, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(c, F.lit(fmt)))


def silver_orders(
    bronze: DataFrame,
    strict_nan: bool = False,
    now: Column | None = None,
    dedup: bool = True,
) -> DataFrame:
    """Bronze order envelopes -> silver orders.

    Rows whose event time cannot be read are dropped (bad JSON lands here
    too); missing quantity and amounts become 0; the first arrival per
    (invoice, stock code, quantity, event time) is kept.
    """
    return cleaned_orders(parse_orders(bronze, strict_nan, typed=True), now, dedup)


def cleaned_orders(flat: DataFrame, now: Column | None = None, dedup: bool = True) -> DataFrame:
    """Parsed and typed order events -> silver orders (``silver_orders`` past its parse)."""
    clean = flat.filter(F.col("event_time").isNotNull()).fillna(ORDER_FILLS)
    if dedup:
        clean = keep_first(clean, ORDER_KEYS, ARRIVAL_ORDER)
    return clean.withColumns(
        {
            "silver_ingestion_time": F.current_timestamp() if now is None else now,
            "year": F.year("event_time"),
            "month": F.month("event_time"),
        }
    )


def silver_customers(bronze: DataFrame, now: Column | None = None) -> DataFrame:
    """Bronze customer envelopes -> silver customers (no NaN repair; rows
    without a customer id dropped; first arrival per (customer, first seen)
    kept; a row with an unreadable first-seen time is kept with a null)."""
    flat = expand_once(bronze, ENVELOPE_COLUMNS, parse("raw_json", CUSTOMER_EVENT))
    typed = flat.withColumn("first_seen_time", wall_clock("first_seen_time", CUSTOMER_TIME_FORMAT)).filter(
        F.col("customer_id").isNotNull()
    )
    return keep_first(typed, CUSTOMER_KEYS, ARRIVAL_ORDER).withColumn(
        "silver_ingestion_time", F.current_timestamp() if now is None else now
    )
