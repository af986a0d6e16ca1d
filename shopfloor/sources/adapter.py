"""Retail view of the supplied TPC-H-style tables.

The supplied tables have no guests, no missing descriptions and no explicit
cancellations, so the mapping supplies them while keeping every line:

* invoice     = order key; the invoice date is the order date
* stock code  = part brand; description = part name, missing for parts whose
  key is a multiple of 97
* customer    = order's customer, a guest (null) when its key is a multiple
  of 5; country = the customer's nation name
* a line with return flag ``R`` is a cancellation

Every line of ``lineitem`` is kept: order, part, customer and nation are looked
up with left joins on their primary keys (a line without an order has no date
and no customer), so a lookup whose columns are not requested is skipped without
changing the row set.  At scale that saves whole shuffles of the line table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.periods import date_key
from shopfloor.sources.tables import TableSet

# Fixed values of the mapping (shared with the SQL oracle).
GUEST_MODULUS = 5
MISSING_DESCRIPTION_MODULUS = 97
CANCEL_FLAG = "R"

SALES_COLUMNS = [
    "invoice_id",
    "stock_code",
    "description",
    "quantity",
    "unit_price",
    "total_amount",
    "country",
    "customer_id",
    "event_time",
    "is_cancelled",
    "date_key",
    "year",
    "month",
    "line_number",
]

_PART_COLUMNS = {"stock_code", "description", "unit_price"}
_COUNTRY_COLUMNS = {"country"}
_ORDER_COLUMNS = {"customer_id", "event_time", "date_key", "year", "month"} | _COUNTRY_COLUMNS


def _orders_with_country(tables: TableSet, with_country: bool) -> DataFrame:
    orders = tables["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    if not with_country:
        return orders
    # nation is tiny (one row per country); Spark broadcasts it on its size.
    cust = (
        tables["customer"]
        .select("c_custkey", "c_nationkey")
        .join(tables["nation"].select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("c_custkey", F.col("n_name").alias("country"))
    )
    return orders.join(cust, orders.o_custkey == cust.c_custkey, "left").drop("c_custkey")


def sales_lines(tables: TableSet, columns: Iterable[str] | None = None) -> DataFrame:
    """Fact-shaped sales lines (created and cancelled) with only ``columns``.

    Amounts and quantities are non-negative; ``is_cancelled`` marks
    cancellations.  ``customer_id`` is a string, null for guests.
    """
    wanted = list(SALES_COLUMNS if columns is None else columns)
    unknown = set(wanted) - set(SALES_COLUMNS)
    if unknown:
        raise ValueError(f"unknown sales columns: {sorted(unknown)}")
    need = set(wanted)

    li = tables["lineitem"].select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    df = li
    if need & _ORDER_COLUMNS:
        orders = _orders_with_country(tables, bool(need & _COUNTRY_COLUMNS))
        df = df.join(orders, li.l_orderkey == orders.o_orderkey, "left")
    if need & _PART_COLUMNS:
        part = tables["part"].select("p_partkey", "p_brand", "p_name", "p_retailprice")
        df = df.join(part, df.l_partkey == part.p_partkey, "left")

    guest = F.col("o_custkey") % GUEST_MODULUS == 0
    described = F.when(F.col("l_partkey") % MISSING_DESCRIPTION_MODULUS == 0, F.lit(None).cast("string"))
    exprs = {
        "invoice_id": F.col("l_orderkey").cast("string"),
        "stock_code": F.col("p_brand"),
        "description": described.otherwise(F.col("p_name")),
        "quantity": F.col("l_quantity").cast("int"),
        "unit_price": F.col("p_retailprice"),
        "total_amount": F.col("l_extendedprice"),
        "country": F.col("country"),
        "customer_id": F.when(guest, F.lit(None).cast("string")).otherwise(F.col("o_custkey").cast("string")),
        "event_time": F.col("o_orderdate"),
        "is_cancelled": F.col("l_returnflag") == CANCEL_FLAG,
        "date_key": date_key("o_orderdate"),
        "year": F.year("o_orderdate"),
        "month": F.month("o_orderdate"),
        "line_number": F.col("l_linenumber"),
    }
    return df.select(*[exprs[c].alias(c) for c in wanted])


def sales(tables: TableSet, columns: Iterable[str] | None = None) -> DataFrame:
    """Confirmed sales only (cancellations removed)."""
    cols = list(SALES_COLUMNS if columns is None else columns)
    extra = [] if "is_cancelled" in cols else ["is_cancelled"]
    return sales_lines(tables, cols + extra).filter(~F.col("is_cancelled")).select(*cols)


RAW_COLUMNS = {
    "Invoice": ("invoice_id",),
    "StockCode": ("stock_code",),
    "Description": ("description",),
    "Quantity": ("quantity", "is_cancelled"),
    "InvoiceDate": ("event_time",),
    "Price": ("unit_price",),
    "Customer ID": ("customer_id",),
    "Country": ("country",),
    "LineNumber": ("line_number",),
}


def raw_sales_lines(tables: TableSet, columns: Iterable[str] | None = None) -> DataFrame:
    """The 8-column raw sales table (quantity negative for cancellations),
    plus ``LineNumber``: the line's position in its invoice, which a replay
    uses as the arrival order of the invoice's events.  With ``columns`` only
    these, and only the lookups they need.
    """
    wanted = list(RAW_COLUMNS if columns is None else columns)
    df = sales_lines(tables, dict.fromkeys(c for w in wanted for c in RAW_COLUMNS[w]))
    exprs = {
        "Quantity": lambda: F.when(F.col("is_cancelled"), -F.col("quantity")).otherwise(F.col("quantity")),
        "Customer ID": lambda: F.col("customer_id").cast("long"),
    }
    return df.select(*[exprs.get(w, lambda w=w: F.col(RAW_COLUMNS[w][0]))().alias(w) for w in wanted])
