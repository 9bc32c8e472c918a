"""Schemas and column types of every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# Money is exact decimal from ingest on, with six decimals and as many digits as
# keep quantity * price * (1 - discount) exact: 10 + 15 + 1, and 10 more for
# (1 - discount), is 37 digits. A price of ten digits or a discount of four is malformed.
PRICE = T.DecimalType(15, 6)
RATE = T.DecimalType(9, 6)
TOTAL = T.DecimalType(24, 6)
MARGIN = T.DecimalType(9, 6)
# Results of the formulas at those widths: 25 digits before the point for revenue, 29
# for revenue times a margin. So no row can overflow them.
AMOUNT = T.DecimalType(27, 2)
PROFIT = T.DecimalType(31, 2)
# Report outputs. Values are widened before they are summed.
MONEY_SUM = "decimal(38,2)"
MONEY_AVG = "decimal(30,2)"

KEY = "transaction_id"
CORRUPT = "_corrupt_record"
REASONS = "_reasons"   # why a line is corrupt, as codes

RAW_COLUMNS = [
    "transaction_id", "customer_id", "product_id", "category", "city", "state",
    "quantity", "unit_price", "discount", "total_amount", "payment_method",
    "order_date", "delivery_date",
]


def raw_schema() -> T.StructType:
    """The 13 source columns, all nullable; dates stay text until cleaning."""
    s = T.StringType()
    return T.StructType([
        T.StructField("transaction_id", s),
        T.StructField("customer_id", s),
        T.StructField("product_id", s),
        T.StructField("category", s),
        T.StructField("city", s),
        T.StructField("state", s),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", PRICE),
        T.StructField("discount", RATE),
        T.StructField("total_amount", TOTAL),
        T.StructField("payment_method", s),
        T.StructField("order_date", s),
        T.StructField("delivery_date", s),
    ])


def raw_ddl(with_corrupt: bool = False) -> str:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw_schema().fields)
    return ddl + (f", `{CORRUPT}` string" if with_corrupt else "")


# Columns added by transform and validate, in output order.
DERIVED_COLUMNS = [
    "revenue", "profit_margin", "profit", "delivery_days",
    "order_month", "order_year", "order_year_month",
]
FLAG_COLUMNS = ["revenue_consistent", "date_integrity_ok"]
# Pipeline-internal columns left out of the warehouse table.
INTERNAL_COLUMNS = ["profit_margin", "revenue_consistent", "date_integrity_ok"]
