"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import remove_path, scratch_path

# --- Fixed values of the query contracts: character classes. -------------------
SPACE_CLASS = r"\x20\x09-\x0D"                       # between words
WORD = rf"[^{SPACE_CLASS}]+"                         # a word
TERM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"         # between benchmark terms, after lower-casing
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# --- end of fixed values ---------------------------------------------------------
HOT_SHARE, HOT_ROWS = 1000, 100   # a key with over one in so many rows, and over so many, is split


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def id_bucket(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % n, F.lit(-1))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would touch other letters)."""
    return F.translate(c, UPPER, LOWER)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder, read back: later
    plans start from files that survive a lost executor, and see their real size."""
    return read_written(df, write_scratch(df, name))


def write_scratch(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def read_written(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        remove_path(spark, p)


def by_ranges(df: DataFrame, *cols: str, part: str = "part") -> DataFrame:
    """Rows dealt into ranges of ``cols`` (sampled bounds, so a hot value of the
    first column is spread over several ranges by the next ones), each row with
    the number of its range; ranges are ordered like ``cols``. The numbers hold
    only once written, as a re-run may draw other bounds."""
    return df.repartitionByRange(*cols).withColumn(part, F.spark_partition_id())


def join_split(left: DataFrame, right: DataFrame, left_key: str, right_key: str, total: int,
               how: str = "inner") -> DataFrame:
    """``left`` (of at most ``total`` rows) joined to ``right``, which has one row per
    key. A key with more than ``total / HOT_SHARE`` rows is dealt over as many salts
    as that share goes into it, and its row of ``right`` repeated for each. There are
    fewer than ``HOT_SHARE`` such keys (they are broadcast) and at most twice as many
    salts, whatever the input. Salts are a function of the row, so re-run tasks agree."""
    share = max(HOT_ROWS, math.ceil(total / HOT_SHARE))
    hot = (left.groupBy(F.col(left_key).alias("hot_key")).agg(F.count(F.lit(1)).alias("hot_n"))
           .filter(F.col("hot_key").isNotNull() & (F.col("hot_n") > share))
           .select("hot_key", F.ceil(F.col("hot_n") / share).cast("int").alias("hot_salts")))
    salt = F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("hot_salts")), F.lit(0)).cast("int")
    salts = F.sequence(F.lit(0), F.coalesce("hot_salts", F.lit(1)) - 1)
    dealt = left.join(F.broadcast(hot), F.col(left_key) == F.col("hot_key"), "left").select(*left.columns, salt.alias("salt"))
    copied = (right.join(F.broadcast(hot), F.col(right_key) == F.col("hot_key"), "left")
              .select(*right.columns, F.explode(salts).alias("right_salt")))
    return (dealt.join(copied, (F.col(left_key) == F.col(right_key)) & (F.col("salt") == F.col("right_salt")), how)
            .drop("salt", "right_salt"))
