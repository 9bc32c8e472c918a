"""Lookups in a table: a left join that keeps every row once, whatever the table's size.

The literal maps of T2 and T4 fold into a projection; a lookup that is a table (a
product catalogue, city aliases kept by another team) is joined. ``prepared`` writes it
once, one row per key, and measures it in that job. A lookup within
``BROADCAST_BYTES`` is broadcast, so the facts are not shuffled. A larger one is joined by
sort and merge on its key; fact keys with over a thousandth of all rows are measured
and dealt over salts first, their lookup rows repeated for each, and rows without a
key (which match nothing) over as many, so no task gets a hot key whole.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

# A lookup of so many bytes (as measured below) is sent to every executor.
BROADCAST_BYTES = 8 << 20
# Bytes counted for a column besides its text.
COLUMN_BYTES = 16
# A key with over one in so many fact rows, and over so many, is dealt over salts.
HOT_SHARE, HOT_ROWS = 1000, 100
KEY, VALUES = "_lookup_key", "_lookup_values"


@dataclass(frozen=True)
class Lookup:
    """``table`` (KEY, VALUES struct; one row per key, read from where it was written), its rows and bytes."""
    table: DataFrame
    rows: int
    size: int

    def small(self, limit: int) -> bool:
        return self.size <= limit


def prepared(table: DataFrame, key: str, values: list[str] | None = None) -> Lookup:
    """``table`` as a lookup of ``values`` (default: all other columns) by ``key``. Rows without a key match
    nothing and are left out, repeated rows are one. Keys with several values are an error, as any choice
    would be silent."""
    values = values or [c for c in table.columns if c != key]
    if not values:
        raise ValueError("a lookup needs a value column")
    found = (table.filter(F.col(key).isNotNull())
             .select(F.col(key).alias(KEY), F.struct(*[F.col(v) for v in values]).alias(VALUES))
             .groupBy(KEY).agg(F.min(VALUES).alias(VALUES), F.max(VALUES).alias("_last")))
    width = [F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) + COLUMN_BYTES
             for c in (F.col(KEY), *[F.col(VALUES)[v] for v in values])]
    size = F.sum(sum(width[1:], width[0]).cast("bigint"))
    seen = Observation("lookup")
    # above the exchange, so in the result stage: counted once per partition
    measured = found.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(size, F.lit(0)).alias("size"),
                             F.count_if(~F.col(VALUES).eqNullSafe(F.col("_last"))).alias("torn"))
    path = scratch_path(table.sparkSession, "lookup")
    kept = measured.drop("_last")
    kept.write.parquet(path)
    if seen.get["torn"]:
        raise ValueError(f"{seen.get['torn']} keys of the lookup have several values")
    return Lookup(table.sparkSession.read.schema(kept.schema).parquet(path), seen.get["rows"], seen.get["size"])


def as_lookup(source: DataFrame | Lookup) -> Lookup:
    """A two-column frame (key, value) prepared; a ``Lookup`` as it is."""
    return source if isinstance(source, Lookup) else prepared(source, source.columns[0], source.columns[1:])


def is_table(source: object) -> bool:
    return not isinstance(source, Mapping)


def hot_keys(df: DataFrame, on: Column) -> DataFrame:
    """(hot_key, hot_salts): the keys with over a thousandth of the rows of ``df``, fewer than a thousand.
    One pass over the key alone, with partial counts."""
    spark, seen = df.sparkSession, Observation("keys")
    counts = df.select(on.alias("hot_key")).filter("hot_key IS NOT NULL").groupBy("hot_key").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "lookup-keys")
    counts.observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("total")).write.parquet(path)
    share = max(HOT_ROWS, math.ceil(seen.get["total"] / HOT_SHARE))
    return (spark.read.schema(counts.schema).parquet(path).filter(F.col("n") > share)
            .select("hot_key", F.ceil(F.col("n") / share).cast("int").alias("hot_salts")))


def attach(df: DataFrame, lookup: Lookup, on: Column, into: str, limit: int = BROADCAST_BYTES,
           hot: DataFrame | None = None) -> DataFrame:
    """``df`` with column ``into``: the struct of values that ``lookup`` has for ``on``, NULL if it has none.
    ``hot``: ``hot_keys`` of a frame with the same keys, where measuring ``df`` itself would run it twice."""
    if lookup.small(limit):
        right = F.broadcast(lookup.table.withColumnRenamed(VALUES, into))
        return df.withColumn("_on", on).join(right, F.col("_on") == F.col(KEY), "left").drop("_on", KEY)
    hot = hot_keys(df, on) if hot is None else hot
    hash_of = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    # fewer than HOT_SHARE rows of a key and a number
    dealt = df.withColumn("_on", on).join(F.broadcast(hot), F.col("_on") == F.col("hot_key"), "left")
    salts = F.when(F.col("_on").isNull(), HOT_SHARE).otherwise(F.coalesce("hot_salts", F.lit(1)))
    dealt = dealt.withColumn("_salt", F.pmod(hash_of, salts).cast("int")).drop("hot_key", "hot_salts")
    copies = F.sequence(F.lit(0), F.coalesce("hot_salts", F.lit(1)) - 1)
    right = (lookup.table.join(F.broadcast(hot), F.col(KEY) == F.col("hot_key"), "left")
             .select(KEY, F.col(VALUES).alias(into), F.explode(copies).alias("_copy")))
    met = (F.col("_on") == F.col(KEY)) & (F.col("_salt") == F.col("_copy"))
    return dealt.join(right.hint("merge"), met, "left").drop("_on", "_salt", "_copy", KEY)
