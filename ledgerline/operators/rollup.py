"""Distinct counts from mergeable bitmaps (A1, A4 where ids may repeat).

Two distinct counts in one aggregation make Spark expand every row into three.
Here each id column is counted by itself: its distinct (group, id) pairs, from a scan
of just these columns with partial aggregation, become bits of a bitmap per group and
32,768 ids. Bitmaps are exact and merge by OR, so the count of any union of groups (all
states, say) and of any further batch needs no second look at the rows, which a
stored ``COUNT(DISTINCT)`` does.

Ids get numbers from a dictionary that is written once and can be extended: the
ids of a task are numbered in a row, so bitmaps are dense whatever the ids look like. A
bitmap row is 4 KB and never more than one per group and 32,768 ids, nor than one
per pair. A hot id (the guest customer) is one row per task after partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import avg_half_up
from ledgerline.operators.reports import money_sum
from ledgerline.schema import KEY
from ledgerline.session import scratch_path

BITS = 32768   # of one bitmap, as Spark's bitmap functions have it


def id_codes(df: DataFrame, column: str, old: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """(id, code): a number from 1 on for each id of ``df``, written to ``path`` (default: the shared folder).
    With ``old``, the dictionary of earlier rows: that and the ids it lacks. NULL is no id."""
    spark, path = df.sparkSession, path or scratch_path(df.sparkSession, "id-codes")
    ids = df.select(F.col(column).alias("id")).filter("id IS NOT NULL").distinct()
    first = 1
    if old is not None:
        ids = ids.join(old, "id", "left_anti")
        first = -(-(old.agg(F.max("code")).first()[0] or 0) // BITS) * BITS + 1   # not into a bitmap that is there
    # numbers leave a gap between tasks, none within one; they hold as they are written before use
    new = ids.select("id", (F.monotonically_increasing_id() + first).alias("code"))
    (new if old is None else old.unionByName(new)).write.parquet(path)
    return spark.read.schema(new.schema).parquet(path)


def id_bitmaps(df: DataFrame, column: str, by: list[str], codes: DataFrame) -> DataFrame:
    """(*by, bucket, bits): the ids of each group as bitmaps."""
    pairs = df.select(*by, F.col(column).alias("id")).filter("id IS NOT NULL").distinct()
    return (pairs.join(codes, "id").groupBy(*by, F.bitmap_bucket_number("code").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits")))


def merged(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several batches under one dictionary (their union)."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bitmaps: DataFrame, by: list[str], name: str) -> DataFrame:
    """(*by, name): the distinct ids of each group; one row, 0 for no ids, if ``by`` is empty."""
    return merged(bitmaps, by).groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias(name))


def state_bitmaps(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orders, customers) by state, written: A1 and A4 both count from these."""
    out = []
    for column in (KEY, "customer_id"):
        bitmaps = id_bitmaps(df, column, ["state"], id_codes(df, column))
        path = scratch_path(df.sparkSession, "id-bitmaps")
        bitmaps.write.parquet(path)
        out.append(df.sparkSession.read.schema(bitmaps.schema).parquet(path))
    return out[0], out[1]


def revenue_by_state(df: DataFrame, bitmaps: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """A4, equal to ``reports.revenue_by_state`` with ids that may repeat."""
    orders, customers = bitmaps or state_bitmaps(df)
    found = df.groupBy("state").agg(money_sum("revenue").alias("total_revenue"))
    for counts in (counted(orders, ["state"], "total_orders"), counted(customers, ["state"], "total_customers")):
        right = counts.withColumnRenamed("state", "of")
        name = counts.columns[-1]
        found = (found.join(right, F.col("state").eqNullSafe(F.col("of")), "left").drop("of")
                 .withColumn(name, F.coalesce(name, F.lit(0).cast("bigint"))))
    return found.orderBy(F.desc("total_revenue"), "state")


def sales_kpis(df: DataFrame, bitmaps: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """A1, equal to ``reports.sales_kpis`` with ids that may repeat."""
    orders, customers = bitmaps or state_bitmaps(df)
    sums = df.agg(money_sum("revenue").alias("total_revenue"), avg_half_up("revenue").alias("average_order_value"))
    # one row each
    one = sums.withColumn("_one", F.lit(1))
    for counts in (counted(orders, [], "total_orders"), counted(customers, [], "total_customers")):
        one = one.join(counts.withColumn("_one", F.lit(1)), "_one")
    return one.select("total_revenue", "total_orders", "average_order_value", "total_customers")
