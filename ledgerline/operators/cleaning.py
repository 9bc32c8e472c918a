"""Cleaning (J1, J2, I1-I7): deduplicate, impute, correct, parse dates.

Shuffle plan of ``deduplicate``: two aggregations, both with map-side
partial aggregation, so a hot key (a NULL id holding a third of the rows, say)
is collapsed inside each map task before it crosses the network:

1. group by all 13 columns -> one row per distinct row plus its copy count (J1,
   hash aggregate);
2. group by ``transaction_id`` -> the survivor ``min(struct(other 12 columns))``
   (ascending, NULLs first, field by field) plus the variant and copy counts
   (J2; sort-based aggregate, since a struct of strings is not a fixed-width
   hash buffer; it spills like any external sort).

When only the survivor is needed, Catalyst drops step 1 by itself (``min`` does
not care about duplicates), leaving one shuffle. The survivor is
deterministic, unlike ``dropDuplicates([key])``; a window ``row_number`` would
give the same row but with no map-side combine, so one hot key would land in
one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    GUEST_CUSTOMER,
    NO_CATEGORY,
    NO_CITY,
    NO_PAYMENT_METHOD,
    abs_quantity,
    parse_date,
)
from ledgerline.schema import KEY
from ledgerline.session import scratch_path

COPIES = "_copies"      # raw rows behind a survivor
VARIANTS = "_variants"  # distinct rows behind a survivor

STAT_KEYS = [
    "rows_before_cleaning",
    "exact_duplicate_rows_removed",
    "duplicate_transaction_ids_removed",
    "missing_customer_id_imputed",
    "missing_payment_method_imputed",
    "missing_category_imputed",
    "missing_city_imputed",
    "negative_quantities_corrected",
    "invalid_order_dates_dropped",
    "rows_after_cleaning",
    "total_rows_removed",
]


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One row per distinct full row."""
    return df.dropDuplicates()


def deduplicate(df: DataFrame, key: str = KEY, keep_counts: bool = False) -> DataFrame:
    """J1 + J2: one row per key, the least row by the other columns in order.

    With ``keep_counts`` the result carries ``_variants`` (distinct rows of the
    key) and ``_copies`` (raw rows of the key) for the cleaning statistics.
    """
    cols = df.columns
    others = [c for c in cols if c != key]
    distinct_rows = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(COPIES))
    per_key = distinct_rows.groupBy(key).agg(
        F.expr(f"min(struct({', '.join(_q(c) for c in others)}))").alias("_keep"),
        F.count(F.lit(1)).alias(VARIANTS),
        F.sum(COPIES).alias(COPIES),
    )
    out = [_q(c) if c == key else f"_keep.{_q(c)} AS {_q(c)}" for c in cols]
    return per_key.selectExpr(*out, *([VARIANTS, COPIES] if keep_counts else []))


# A key that may hold over this share of all rows is deduplicated with partial aggregation.
FREQUENT = 0.001


def frequent_keys(df: DataFrame, key: str = KEY, share: float = FREQUENT) -> list:
    """Keys that may hold over ``share`` of the rows: all that do, and some others, a few thousand at
    most (counters per task, merged). Reads the key alone."""
    return [k for k in df.stat.freqItems([key], share).first()[0] or [] if k is not None]


def deduplicate_once(df: DataFrame, frequent: list, key: str = KEY, keep_counts: bool = False) -> DataFrame:
    """``deduplicate`` with one shuffle of whole rows in place of two, for a frame that is cheap to read
    twice (a written table). Rows are dealt by key once; distinct rows and the key's survivor are
    then both found where they are. That would put a frequent key whole into one task, so
    the ``frequent`` ones (``frequent_keys``) and rows without a key go the other way, collapsed in
    each map task first. Same rows as ``deduplicate``."""
    hot = F.col(key).isNull() | (F.col(key).isin(frequent) if frequent else F.lit(False))
    rest = deduplicate(df.filter(~hot).repartition(F.col(key)), key, keep_counts)
    return rest.unionByName(deduplicate(df.filter(hot), key, keep_counts))


# Bits of the bitmap of repeated ids that every executor gets, at most (64 MB), and bits for each such id.
MOST_BITS, ID_BITS = 1 << 29, 16
BITMAP = 32768   # bits of one row, as Spark's bitmap functions have it


def repeated_bitmap(df: DataFrame, *key: str) -> tuple[DataFrame, int]:
    """((``_bucket``, ``_bits``) rows; the number of bits): a bit for each hash of a key (``KEY``, or the columns
    given) that has several rows, NULL a key like any other. Reads and shuffles 64-bit hashes alone."""
    spark, seen = df.sparkSession, Observation("repeated")
    found = (df.select(F.xxhash64(*key or [KEY]).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
             .filter("_n > 1").select("_hash"))
    path = scratch_path(spark, "repeated-keys")
    # above the exchange, so in the result stage: counted once per partition
    found.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    bits = min(MOST_BITS, max(BITMAP, 1 << (seen.get["n"] * ID_BITS).bit_length()))
    code = _bit_of(F.col("_hash"), bits)
    rows = (spark.read.schema(found.schema).parquet(path).groupBy(F.bitmap_bucket_number(code).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(code)).alias("_bits")))
    path = scratch_path(spark, "repeated-bits")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), bits


def _bit_of(hashed: Column, bits: int) -> Column:
    return F.pmod(hashed, F.lit(bits).cast("bigint")) + 1   # the functions count from one


def split_repeated(df: DataFrame, *key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key, of one or more columns, no other row has; the others), without a shuffle of rows, for a
    frame that is cheap to read several times. A row whose key has no bit in ``repeated_bitmap`` is one of the
    first; those with a bit, some with a key of their own among them, the more the fuller the
    bitmap, are the others."""
    bitmap, bits = repeated_bitmap(df, *key)
    code = _bit_of(F.xxhash64(*key), bits)
    found = df.withColumn("_code", code).join(F.broadcast(bitmap), F.bitmap_bucket_number("_code") == F.col("_bucket"), "left")
    position = F.bitmap_bit_position("_code")
    octet = F.conv(F.hex(F.substring("_bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    flagged = found.withColumn("_again", F.coalesce(F.getbit(octet, (position % 8).cast("int")) == 1, F.lit(False)))
    once = flagged.filter(~F.col("_again")).select(*[F.col(_q(c)) for c in df.columns])
    again = flagged.filter("_again").select(*[F.col(_q(c)) for c in df.columns])
    return once, again


def deduplicate_written(df: DataFrame, key: str = KEY, keep_counts: bool = False) -> DataFrame:
    """``deduplicate`` for a written table, where rows with an id of their own are not shuffled: they are
    the survivors as they are. The others of ``split_repeated`` go through ``deduplicate_once``. Same
    rows as ``deduplicate``."""
    once, again = split_repeated(df, key)
    if keep_counts:
        once = once.select("*", *[F.lit(1).cast("bigint").alias(c) for c in (VARIANTS, COPIES)])
    return once.unionByName(deduplicate_once(again, frequent_keys(df, key), key, keep_counts))


def _q(c: str) -> str:
    return f"`{c}`"


def _imputed() -> dict[str, Column]:
    return {
        "customer_id": F.coalesce(F.col("customer_id"), F.lit(GUEST_CUSTOMER)),
        "payment_method": F.coalesce(F.col("payment_method"), F.lit(NO_PAYMENT_METHOD)),
        "category": F.coalesce(F.col("category"), F.lit(NO_CATEGORY)),
        "city": F.coalesce(F.col("city"), F.lit(NO_CITY)),
    }


def _parsed_dates() -> dict[str, Column]:
    return {"order_date": parse_date("order_date"), "delivery_date": parse_date("delivery_date")}


def impute_defaults(df: DataFrame) -> DataFrame:
    """NULL-only placeholders; rows are kept so their revenue counts."""
    return df.withColumns(_imputed())


def correct_quantity(df: DataFrame) -> DataFrame:
    """Negative quantities are sign errors; NULL stays NULL."""
    return df.withColumn("quantity", abs_quantity("quantity"))


def parse_dates(df: DataFrame, drop_invalid: bool = True) -> DataFrame:
    """I6 + F7: text dates to DATE (bad text -> NULL); rows whose order date does
    not parse are dropped, an unparseable delivery date just stays NULL."""
    out = df.withColumns(_parsed_dates())
    return out.filter(F.col("order_date").isNotNull()) if drop_invalid else out


def _clean_columns(df: DataFrame) -> DataFrame:
    """I1-I6 + F7 in one projection and one filter (same result as
    ``parse_dates(correct_quantity(impute_defaults(df)))``)."""
    out = df.withColumns({**_imputed(), "quantity": abs_quantity("quantity"), **_parsed_dates()})
    return out.filter(F.col("order_date").isNotNull())


def stats_columns() -> list[Column]:
    """I7 as aggregate expressions over the output of ``deduplicate(keep_counts=True)``.

    Missing and negative counts are taken after dedup and before bad order
    dates are dropped, as in the source job. No DISTINCT, so the same list
    works in ``agg`` and in ``DataFrame.observe``.
    """
    def n_if(cond: Column) -> Column:
        return F.count_if(cond).cast("bigint")

    before = F.coalesce(F.sum(COPIES), F.lit(0)).cast("bigint")
    bad_dates = n_if(parse_date("order_date").isNull())
    kept = F.count(F.lit(1)).cast("bigint")
    variants = F.coalesce(F.sum(VARIANTS), F.lit(0)).cast("bigint")
    return [
        before.alias("rows_before_cleaning"),
        (before - variants).alias("exact_duplicate_rows_removed"),
        (variants - kept).alias("duplicate_transaction_ids_removed"),
        n_if(F.col("customer_id").isNull()).alias("missing_customer_id_imputed"),
        n_if(F.col("payment_method").isNull()).alias("missing_payment_method_imputed"),
        n_if(F.col("category").isNull()).alias("missing_category_imputed"),
        n_if(F.col("city").isNull()).alias("missing_city_imputed"),
        n_if(F.col("quantity") < 0).alias("negative_quantities_corrected"),
        bad_dates.alias("invalid_order_dates_dropped"),
        (kept - bad_dates).alias("rows_after_cleaning"),
        (before - kept + bad_dates).alias("total_rows_removed"),
    ]


def cleaning_stats(deduped_with_counts: DataFrame) -> DataFrame:
    """I7 as one aggregate row."""
    return deduped_with_counts.agg(*stats_columns())


def clean_data(df: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """Returns (cleaned frame, one-row statistics frame); both lazy.

    Both read the same deduplicated frame; ``plans.pipeline.run`` gets the
    statistics in the same pass as the processed-table write instead.
    """
    deduped = deduplicate(df, key, keep_counts=True)
    return clean_deduped(deduped), cleaning_stats(deduped)


def clean(df: DataFrame, key: str = KEY) -> DataFrame:
    """The cleaned frame alone (J1, J2, I1-I6, F7), without the statistics."""
    return _clean_columns(deduplicate(df, key))


def clean_deduped(deduped_with_counts: DataFrame) -> DataFrame:
    """Cleaning after deduplication: drops the count columns, imputes, fixes."""
    return _clean_columns(deduped_with_counts.drop(VARIANTS, COPIES))
