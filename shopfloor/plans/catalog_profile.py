"""Registered profiling queries (PRO-01..19) over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.json import expand_once, json_field, repair_nan
from shopfloor.operators import events as evt
from shopfloor.operators import profile as pro
from shopfloor.operators import silver
from shopfloor.schemas import ENVELOPE_COLUMNS
from shopfloor.session import dealt, pin
from shopfloor.sources import adapter, streams
from shopfloor.sources.tables import TableSet

RAW8 = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]
KEY3 = ["Invoice", "StockCode", "InvoiceDate"]
KEY4 = KEY3 + ["Quantity"]
LOOKUP_COUNTRY = "NATION_7"


def _t(spark, sf_dir) -> TableSet:
    return TableSet(spark, sf_dir)


def _raw(t: TableSet, *columns: str) -> DataFrame:
    return adapter.raw_sales_lines(t, columns or None)


def _whole_lines(t: TableSet) -> DataFrame:
    """The eight raw columns, dealt with the line number beside them (so that a line's
    copies part): whole lines hardly repeat, so grouping holds all rows of a task."""
    return dealt(_raw(t, *RAW8, "LineNumber")).select(*RAW8)


def nan_order_bronze(t: TableSet) -> DataFrame:
    """Order topic replay as the original producer wrote it: missing
    description / price / amount serialised as bare ``NaN``.  A payload is
    written once, whatever probes and filters ask of it."""
    records = evt.order_records(evt.order_events(_raw(t)))
    rest = [c for c in records.columns if c != "value"]
    records = expand_once(records, rest, F.struct(evt.with_bare_nan("value").alias("value")))
    return streams.bronze_envelope(streams.replay_records(records, evt.ORDER_TOPIC))


def _parsed_orders(bronze: DataFrame) -> DataFrame:
    return silver.parse_orders(bronze, typed=True)


def q_null_counts(spark, sf_dir):
    return pro.null_counts(_raw(_t(spark, sf_dir)).select(*RAW8))


def q_event_type_counts(spark, sf_dir):
    from shopfloor.plans.catalog import order_bronze

    b = order_bronze(_t(spark, sf_dir))
    return pro.value_counts(b, json_field("raw_json", "$.event_type"), "event_type")


def q_describe(spark, sf_dir):
    return pro.describe_numeric(_raw(_t(spark, sf_dir), "Quantity", "Price"), ["Quantity", "Price"])


def q_unreadable_json(spark, sf_dir):
    return pro.unreadable_json(nan_order_bronze(_t(spark, sf_dir))).select("kafka_key", "partition", "offset")


def q_nan_recovery(spark, sf_dir):
    return pro.nan_recovery(nan_order_bronze(_t(spark, sf_dir)))


def q_offset_gaps(spark, sf_dir):
    return pro.offset_gaps(streams.events_topic(_t(spark, sf_dir)["events"]))


def q_rows_per_topic_partition(spark, sf_dir):
    return pro.value_counts(streams.events_topic(_t(spark, sf_dir)["events"]), "partition", "partition")


def q_duplicate_excess(spark, sf_dir):
    from shopfloor.plans.catalog import order_bronze

    parsed = _parsed_orders(order_bronze(_t(spark, sf_dir)))
    return pro.duplicate_excess(
        parsed,
        {
            "dup_rows_3key": ["invoice_id", "stock_code", "event_time"],
            "dup_rows_4key": ["invoice_id", "stock_code", "event_time", "quantity"],
        },
    )


def q_stage_funnel(spark, sf_dir):
    """Every payload is made, probed and parsed once; the stages are counted from
    what the later ones need of it, one stored row per bronze row."""
    b = nan_order_bronze(_t(spark, sf_dir))
    probed = b.withColumn("readable", json_field(repair_nan("raw_json"), "$.event_type").isNotNull())
    flat = silver.parse_orders(probed, typed=True, keep=[*ENVELOPE_COLUMNS, "readable"])
    used = dict.fromkeys([*silver.ORDER_KEYS, *silver.ARRIVAL_ORDER, *silver.ORDER_FILLS, "readable"])
    typed = pin(flat.select(*used), "funnel_rows")
    timed = typed.filter(F.col("event_time").isNotNull())
    return pro.stage_funnel(
        [("bronze", typed), ("parsed", typed.filter("readable")), ("event_time_present", timed), ("deduplicated", silver.cleaned_orders(typed))]
    )


def q_descriptions_per_code(spark, sf_dir):
    return pro.descriptions_per_code(adapter.sales_lines(_t(spark, sf_dir), ["stock_code", "description"]))


def q_junk_description_codes(spark, sf_dir):
    return pro.junk_description_codes(adapter.sales_lines(_t(spark, sf_dir), ["stock_code", "description"]))


def q_duplicate_lines(spark, sf_dir):
    return pro.duplicate_members(_whole_lines(_t(spark, sf_dir)), KEY4)


def q_full_row_duplicates(spark, sf_dir):
    return pro.full_row_duplicates(_whole_lines(_t(spark, sf_dir)))


def q_conflicting_lines(spark, sf_dir):
    return pro.conflicting_records(_whole_lines(_t(spark, sf_dir)), KEY3, "Quantity")


def q_sign_split(spark, sf_dir):
    return pro.sign_split(_raw(_t(spark, sf_dir), "Quantity", "Price"))


def q_first_seen_years(spark, sf_dir):
    return pro.first_seen_years(_raw(_t(spark, sf_dir), "Customer ID", "InvoiceDate"))


def q_customer_counts(spark, sf_dir):
    return pro.customer_counts(_raw(_t(spark, sf_dir), "Customer ID"))


def q_rows_per_year(spark, sf_dir):
    return pro.rows_per_year(_raw(_t(spark, sf_dir), "InvoiceDate"))


def q_missing_customer_lines(spark, sf_dir):
    from shopfloor.plans.catalog import order_bronze

    so = silver.silver_orders(order_bronze(_t(spark, sf_dir)))
    return so.agg(F.count_if(pro.null_or_empty("customer_id")).alias("lines_without_customer"))


def q_invoice_lookup(spark, sf_dir):
    """All lines of the invoice with the most lines (ties: smallest id) – a
    lookup whose key comes from the data, not from the driver."""
    t = _t(spark, sf_dir)
    raw = _raw(t)
    top = _raw(t, "Invoice").groupBy("Invoice").count().orderBy(F.col("count").desc(), F.col("Invoice")).limit(1)
    return raw.join(top.select("Invoice"), "Invoice", "left_semi")


def q_description_totals(spark, sf_dir):
    return pro.description_totals(adapter.sales_lines(_t(spark, sf_dir), ["stock_code", "description"]))


def q_files(spark, sf_dir):
    """Files and rows behind the line table as it is stored."""
    return pro.file_count(_t(spark, sf_dir)["lineitem"])


def q_country_lookup(spark, sf_dir):
    """PRO-19: the lines of one given country."""
    return pro.lookup(_raw(_t(spark, sf_dir), *RAW8), "Country", LOOKUP_COUNTRY)


def queries() -> dict:
    return {
        "profile_null_counts": q_null_counts,
        "profile_event_type_counts": q_event_type_counts,
        "profile_describe": q_describe,
        "profile_unreadable_json": q_unreadable_json,
        "profile_nan_recovery": q_nan_recovery,
        "profile_offset_gaps": q_offset_gaps,
        "profile_rows_per_topic_partition": q_rows_per_topic_partition,
        "profile_duplicate_excess": q_duplicate_excess,
        "profile_stage_funnel": q_stage_funnel,
        "profile_descriptions_per_code": q_descriptions_per_code,
        "profile_junk_description_codes": q_junk_description_codes,
        "profile_duplicate_lines": q_duplicate_lines,
        "profile_full_row_duplicates": q_full_row_duplicates,
        "profile_conflicting_lines": q_conflicting_lines,
        "profile_sign_split": q_sign_split,
        "profile_first_seen_years": q_first_seen_years,
        "profile_customer_counts": q_customer_counts,
        "profile_rows_per_year": q_rows_per_year,
        "profile_missing_customer_lines": q_missing_customer_lines,
        "profile_invoice_lookup": q_invoice_lookup,
        "profile_description_totals": q_description_totals,
        "profile_files": q_files,
        "profile_country_lookup": q_country_lookup,
    }
