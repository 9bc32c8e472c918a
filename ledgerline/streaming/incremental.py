"""Incremental runs: only files that are new are parsed, and each id keeps one row of a micro-batch.

Two Structured Streaming queries, each run until it has taken what is there
(``availableNow``), so a run is a batch job that remembers where it was:

1. ``ingest_new``: new CSV files -> the parser of the batch run -> ``root/staged``, a
   folder per micro-batch, good rows and malformed lines apart (S3, S5).
2. ``dedup_new``: new good rows -> one row per id and micro-batch, the least by the
   other columns, as J2 keeps -> ``root/changes``, the state of all runs.

Whatever the change log holds of an id are rows it had, and the least of all its rows is
among them. So the log goes through the batch operators as it is, their
dedup included, and gives what one run over all files gives, in whatever
batches they came.

Scale: parsing and the dedup of a micro-batch grow with the new files alone; the log
holds a row per id and micro-batch that touched it, in files, so no executor's memory
holds the ids seen so far (as a state store would, which also commits every one
of its partitions in each micro-batch). The aggregation has partial
counts before its shuffle, so a hot id (a third of all rows without one) is one row
per task. Offsets and output are in ``root``
on the shared file system: a lost executor re-runs tasks, a lost driver re-runs the
micro-batch, which overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import cleaning
from ledgerline.operators.cleaning import COPIES
from ledgerline.plans import pipeline
from ledgerline.schema import CORRUPT, KEY, RAW_COLUMNS, REASONS, raw_schema
from ledgerline.session import make_folder
from ledgerline.sources import csv_ingest

BATCH = "_batch"


def line_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """``csv_ingest.read_lines`` over the files that arrive in ``path``, at most ``max_files`` a micro-batch."""
    reader = spark.readStream.options(**csv_ingest.WHOLE_LINES).schema(csv_ingest.WHOLE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path).select(F.coalesce("_whole", "value").alias("value"))


def _taken(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run a query over what is there now, each micro-batch by ``write``."""
    query = (stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def ingest_new(spark: SparkSession, csv_path: str, root: str, max_files: int | None = None) -> None:
    """S3 + S5 for the files that no earlier call has taken."""
    def write(batch: DataFrame, number: int) -> None:
        csv_ingest.write_staged(batch, f"{root}/staged/{BATCH}={number}")
    _taken(csv_ingest.parse_lines(line_stream(spark, csv_path, max_files)), write, f"{root}/checkpoints/ingest")


def staged_schema() -> T.StructType:
    return T.StructType(raw_schema().fields + [
        T.StructField(CORRUPT, T.StringType()), T.StructField(REASONS, T.ArrayType(T.StringType())),
        T.StructField(BATCH, T.LongType()), T.StructField(csv_ingest.MALFORMED, T.BooleanType())])


def staged(spark: SparkSession, root: str) -> DataFrame:
    """All parsed lines so far."""
    return spark.read.schema(staged_schema()).option("basePath", f"{root}/staged").parquet(f"{root}/staged")


def dedup_new(spark: SparkSession, root: str, max_files: int | None = None) -> None:
    """J1 + J2 over the good rows that no earlier call has taken, those of each micro-batch of ``ingest_new`` by
    themselves. All that are new are taken at once, or ``max_files`` staged files at a time."""
    reader = spark.readStream.schema(staged_schema()).option("basePath", f"{root}/staged")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    good = reader.parquet(f"{root}/staged").filter(~F.col(csv_ingest.MALFORMED))
    others = [c for c in RAW_COLUMNS if c != KEY]

    def write(batch: DataFrame, number: int) -> None:
        once, again = cleaning.split_repeated(batch.select(*RAW_COLUMNS, BATCH), BATCH, KEY)
        least = again.groupBy(BATCH, KEY).agg(F.min(F.struct(*others)).alias("_keep"), F.count(F.lit(1)).alias(COPIES))
        (once.select(*RAW_COLUMNS, F.lit(1).cast("bigint").alias(COPIES))
         .unionByName(least.select(*[F.col(c) if c == KEY else F.col("_keep")[c].alias(c) for c in RAW_COLUMNS], COPIES))
         .write.mode("overwrite").parquet(f"{root}/changes/{BATCH}={number}", compression="zstd"))
    # not the folder of the stateful query that was here before, whose offsets a query without state can't take on
    _taken(good, write, f"{root}/checkpoints/dedup-batches")


def changes(spark: SparkSession, root: str) -> DataFrame:
    """The change log's raw rows; ``cleaning.deduplicate`` makes them the survivors of all files so far."""
    schema = T.StructType(raw_schema().fields + [T.StructField(COPIES, T.LongType()), T.StructField(BATCH, T.LongType())])
    return spark.read.schema(schema).option("basePath", f"{root}/changes").parquet(f"{root}/changes").select(*RAW_COLUMNS)


def run_new(spark: SparkSession, csv_path: str, root: str, max_files: int | None = None, **options) -> pipeline.RunResult:
    """Take the new files of ``csv_path`` and run the pipeline over the survivors of all files so far.
    ``root`` belongs to one such sequence of runs. ``options``: those of ``pipeline.run`` (processed_path,
    reports_dir, margins ...); give ``versioned=True`` to rewrite the same processed table. The result's ingest
    counts are of all files so far; its cleaning statistics are of the change log, whose rows are
    fewer than the files'."""
    root = root.rstrip("/")
    for folder in ("staged", "changes"):   # no batch writes them while there are no rows
        make_folder(spark, f"{root}/{folder}")
    ingest_new(spark, csv_path, root, max_files)
    dedup_new(spark, root)
    result = pipeline.run(spark, raw=changes(spark, root), written=True, **options)
    result.ingest_counts = csv_ingest.ingest_counts(staged(spark, root), by_reason=True).first().asDict()
    return result
