"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target number of words: its share of the budget by weight,
never above ``max_epochs`` times its own size; what a capped source leaves goes
to the others by weight. Complete epochs of the source come first. The rest is
sampled without replacement: a document's key is an exponential variate divided
by its quality weight, documents are taken in ascending order of key until
their summed sizes reach the rest of the target.

Keys are a pure function of (seed, document), so reruns and re-run tasks agree.

Scale: only (source, key, size) is shuffled, never a text. Keys are dealt into
ranges of (source, key), so a source with a third of all rows is spread over
many tasks; a prefix sum is the sum of the ranges before plus the running sum
inside the range. The result of the sort is one cut-off key per source, applied
to the documents in a scan. The tables with one row per source are aggregates.

Defined results: null or blank text has size 0 and any key; a null source is a
source (the last); a source of size 0 has target 0; rows with equal id and text
have equal keys and are taken or left together; an empty table gives an empty
result; other columns of the input pass through untouched, also when they are
named like a result column (result columns are given in a struct of their own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as C

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 42


def word_size(text: str = "text") -> Column:
    return F.regexp_count(C.text_or_empty(text), F.lit(C.WORD)).cast("bigint")


def symbol_quality(text: str = "text") -> Column:
    """Quality weight in [0.1, 1]: falls with the share of symbol characters."""
    t = C.text_or_empty(text)
    symbols = F.length(t) - F.length(F.translate(t, C.SYMBOLS, ""))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(4.0) * symbols / F.greatest(F.lit(1), F.length(t)))


def sampling_key(weight: Column, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> Column:
    """-ln(u) / weight, u uniform in (0, 1) from 52 bits of an MD5 of the document."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
                          C.text_or_empty(text)).cast("binary"))
    u = (F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(float(2 ** 52))
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size) plus ``target``. Sources ordered by code
    point, null last, take ``weights`` in turn.

    Water filling in closed form: in ascending order of cap / weight a source is
    capped if its cap / weight is at most the level that the budget left by the
    sources before it gives to it and all after it; the rest shares the rest."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.row_number().over(in_order) - 1) % len(weights) + 1)
    cap = F.col("source_size") * max_epochs
    budget = F.sum("source_size").over(everything)
    return (sizes.withColumn("weight", w).withColumn("cap", cap)
            .withColumn("level", F.col("cap") / F.col("weight"))
            .withColumn("budget", budget)
            .withColumn("capped", F.col("level") <= (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                        / F.sum("weight").over(onward))
            .withColumn("rest", F.col("budget") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything))
            .withColumn("rest_weight", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything))
            .select("source", "source_size",
                    F.when(F.col("capped"), F.col("cap").cast("double"))
                    .otherwise(F.col("weight") * F.col("rest") / F.col("rest_weight")).alias("target")))


def source_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target, epochs (complete ones) and
    ``cutoff``, the largest key that the fractional selection takes (null: none).
    ``docs`` has source, size and key."""
    keyed = docs.select("source", "size", "key")
    ranged = C.written(C.by_ranges(keyed, "source", "key"), "mix-keys")
    parts = ranged.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    targets = source_targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = C.written(targets.withColumn("epochs", epochs.cast("int"))
                        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (parts.withColumn("start", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
              .join(targets.select(F.col("source").alias("t_source"), "rest"),
                    F.col("source").eqNullSafe(F.col("t_source")))
              # a range can only hold the cut-off if it starts before the target
              .filter(F.col("start") <= F.col("rest"))
              .select(F.col("source").alias("p_source"), F.col("part").alias("p_part"), "start", "rest"))
    # rows of equal key count as one: the frame is by value of the key
    within = Window.partitionBy("source", "part").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    same_key = Window.partitionBy("source", "part", "key")
    chosen = (ranged.join(starts, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("part") == F.col("p_part")))
              .withColumn("upto", F.sum("size").over(within))
              .withColumn("tied", F.sum("size").over(same_key))
              .filter(F.col("start") + F.col("upto") - F.col("tied") / 2.0 <= F.col("rest"))
              .groupBy("source").agg(F.max("key").alias("cutoff"))
              .withColumnRenamed("source", "c_source"))
    return (targets.join(chosen, F.col("source").eqNullSafe(F.col("c_source")), "left")
            .select("source", "source_size", "target", "epochs", "cutoff"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        quality: Column | None = None) -> DataFrame:
    """``docs`` (doc_id, text, source, any other columns) as ``row`` (the input
    row) and ``mix``: size, source_size, target, copies (how often the mix takes
    the document: its source's complete epochs, plus one if selected)."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text", F.col("source"))
    keyed = rows.select("row", "source", word_size().alias("size"),
                        sampling_key(quality if quality is not None else symbol_quality(), seed=seed).alias("key"))
    plan = C.written(source_plan(keyed, weights, max_epochs), "mix-plan")
    plan = plan.withColumnRenamed("source", "m_source")
    copies = F.col("epochs") + F.when(F.col("key") <= F.col("cutoff"), 1).otherwise(0)
    return (keyed.join(plan, F.col("source").eqNullSafe(F.col("m_source")))
            .select("row", F.struct("size", "source_size", "target", copies.cast("int").alias("copies")).alias("mix")))
