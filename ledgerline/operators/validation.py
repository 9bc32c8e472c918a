"""Validation (V1-V5): flag rows, never drop them; reports are one-row frames.

Three-valued logic is kept on purpose: a NULL flag (NULL delivery date or
quantity) is neither a violation in the report (``count_if(NOT flag)`` skips
NULL) nor a clean row for the delivery average (``filter(flag)`` skips NULL).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import REVENUE_TOLERANCE, pct_half_up
from ledgerline.schema import KEY, RAW_COLUMNS

VALIDATION_KEYS = [
    "total_records_validated",
    "duplicate_transaction_ids_found",
    "revenue_inconsistent_records",
    "pct_revenue_consistent",
    "date_integrity_violations",
    "pct_date_integrity_ok",
]

PROFILE_KEYS = [
    "missing_customer_id",
    "missing_payment_method",
    "missing_category",
    "missing_city",
    "negative_quantity",
    "duplicate_rows_exact",
    "duplicate_transaction_ids",
]


def revenue_consistent() -> Column:
    """V2: |total_amount - revenue| strictly below the tolerance."""
    return F.abs(F.col("total_amount") - F.col("revenue")) < F.lit(Decimal(REVENUE_TOLERANCE))


def date_integrity_ok() -> Column:
    """V3: delivery on or after order."""
    return F.col("delivery_date") >= F.col("order_date")


def add_flags(df: DataFrame) -> DataFrame:
    return df.select("*", revenue_consistent().alias("revenue_consistent"),
                     date_integrity_ok().alias("date_integrity_ok"))


def distinct_keys(key: str = KEY) -> Column:
    """Distinct key values counting NULL as one value, as ``select(key).distinct()`` does."""
    has_null = F.max(F.when(F.col(key).isNull(), 1).otherwise(0))
    return (F.count_distinct(F.col(key)) + F.coalesce(has_null, F.lit(0))).cast("bigint")


def uniqueness_check(df: DataFrame, key: str = KEY) -> DataFrame:
    """V1: rows, distinct keys, and duplicates = rows - distinct keys."""
    rows = F.count(F.lit(1)).cast("bigint")
    return df.agg(rows.alias("total_records"), distinct_keys(key).alias("distinct_ids"),
                  (rows - distinct_keys(key)).alias("duplicate_ids"))


def report_counts() -> list[Column]:
    """V4's counts over a flagged frame as aggregate expressions."""
    return [
        F.count(F.lit(1)).cast("bigint").alias("total_records_validated"),
        F.count_if(~F.col("revenue_consistent")).cast("bigint").alias("revenue_inconsistent_records"),
        F.count_if(~F.col("date_integrity_ok")).cast("bigint").alias("date_integrity_violations"),
    ]


def validation_report(flagged: DataFrame, key: str = KEY) -> DataFrame:
    """V4 over a frame that already carries the two flags; one aggregate pass.
    Duplicate ids are counted from the data (one distinct aggregate)."""
    inner = flagged.agg(*report_counts(), distinct_keys(key).alias("_distinct"))
    return inner.select(
        "total_records_validated",
        (F.col("total_records_validated") - F.col("_distinct")).alias("duplicate_transaction_ids_found"),
        "revenue_inconsistent_records",
        pct_half_up("total_records_validated - revenue_inconsistent_records",
                    "total_records_validated").alias("pct_revenue_consistent"),
        "date_integrity_violations",
        pct_half_up("total_records_validated - date_integrity_violations",
                    "total_records_validated").alias("pct_date_integrity_ok"),
    )


def validate_data(df: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """Returns (flagged frame, one-row report frame); both lazy."""
    flagged = add_flags(df)
    return flagged, validation_report(flagged, key)


def quality_profile(raw: DataFrame, key: str = KEY) -> DataFrame:
    """V5: the raw-data profile. NULL counts, negative quantities, rows that belong
    to any exact-duplicate group and rows that belong to any duplicate-key group
    (every member counted, not just the extra copies).

    Three aggregation levels, each with map-side partial aggregation and no
    join: distinct rows with their copy count -> per key -> one row.
    """
    cols = [c for c in RAW_COLUMNS if c in raw.columns]
    copies = F.col("_n")

    def weighted(cond: Column) -> Column:
        return F.sum(F.when(cond, copies).otherwise(0))

    rows = raw.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    per_key = rows.groupBy(key).agg(
        F.sum(copies).alias("_key_rows"),
        F.sum(F.when(copies > 1, copies).otherwise(0)).alias("_exact_dup_rows"),
        weighted(F.col("customer_id").isNull()).alias("_m_customer"),
        weighted(F.col("payment_method").isNull()).alias("_m_payment"),
        weighted(F.col("category").isNull()).alias("_m_category"),
        weighted(F.col("city").isNull()).alias("_m_city"),
        weighted(F.col("quantity") < 0).alias("_neg"),
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return per_key.agg(
        total(F.col("_m_customer")).alias("missing_customer_id"),
        total(F.col("_m_payment")).alias("missing_payment_method"),
        total(F.col("_m_category")).alias("missing_category"),
        total(F.col("_m_city")).alias("missing_city"),
        total(F.col("_neg")).alias("negative_quantity"),
        total(F.col("_exact_dup_rows")).alias("duplicate_rows_exact"),
        total(F.when(F.col("_key_rows") > 1, F.col("_key_rows"))).alias("duplicate_transaction_ids"),
    )
