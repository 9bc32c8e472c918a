"""End-to-end run: ingest -> clean -> transform -> validate -> write -> report.

Statistics are plain aggregates collected with ``DataFrame.observe`` in the
result stage of a write job, where Spark merges each partition's metrics once,
so retried tasks or a lost executor do not count rows twice:

* CSV input is parsed once and written as a typed staging table split by a
  malformed flag (scan -> parse -> write, no shuffle); the ingest counts are
  observed in that job. Reject lines are copied from their staging folder only
  when there are any.
* The processed table is written from the staged rows (or a given frame);
  the cleaning statistics are observed in its writing stage, above the month
  rebalance.
* The validation report, with the duplicate ids, is measured on the table as
  written: a pass over three of its columns that shuffles only keys.

Each later stage reads the written table back, which cuts the lineage: a lost
executor costs a re-read of table files, not a re-parse or a re-run of the
dedup shuffle. Reports read only the columns they need (parquet pruning).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from ledgerline.functions import columns as C
from ledgerline.operators import cleaning, lookups, reports, transform, validation
from ledgerline.plans import sql_reports
from ledgerline.session import remove_path, scratch_path
from ledgerline.sinks import files, jdbc, versions
from ledgerline.sources import csv_ingest

log = logging.getLogger("ledgerline.pipeline")


@dataclass
class RunResult:
    processed: DataFrame
    processed_path: str
    cleaning_stats: dict
    validation_report: dict
    ingest_counts: dict | None = None
    rejects_path: str | None = None   # where the malformed lines are; the staging table if they couldn't be written
    reports: dict[str, DataFrame] = field(default_factory=dict)
    sql_reports: dict[str, DataFrame] = field(default_factory=dict)
    exported: dict[str, str] = field(default_factory=dict)


def process(raw: DataFrame,
            margins: transform.Table = C.DEFAULT_CATEGORY_MARGINS,
            aliases: transform.Table = C.DEFAULT_CITY_ALIASES,
            stats: Observation | None = None, cluster_by_month: bool = False,
            written: bool = False) -> DataFrame:
    """Lazy processed frame (cleaned, transformed, flagged). With ``stats`` the
    cleaning statistics are observed on the deduplicated frame.

    ``cluster_by_month`` rebalances the deduplicated rows by the month of their
    order date (the processed table's partition column) for a partitioned
    write. The rebalance comes before the observation, so the statistics are
    collected in the writing (result) stage, whose task results are merged once
    per partition even when tasks or executors are lost. Lookups that are
    tables are written first, and hot keys measured on ``raw``: on the observed
    frame that would take its statistics too early. ``written``: ``raw`` is a written
    table, so that the dedup may read it again and shuffle only rows of repeated
    ids (``cleaning.deduplicate_written``).
    """
    margins, aliases = (lookups.as_lookup(t) if lookups.is_table(t) else t for t in (margins, aliases))
    hot = transform.hot_lookup_keys(raw, margins, aliases)
    dedup = cleaning.deduplicate_written if written else cleaning.deduplicate
    deduped = dedup(raw, keep_counts=True)
    if cluster_by_month:
        deduped = files.rebalance_by(deduped, C.order_year_month(C.parse_date("order_date")))
    if stats is not None:
        deduped = deduped.observe(stats, *cleaning.stats_columns())
    return validation.add_flags(
        transform.transform_data(cleaning.clean_deduped(deduped), margins, aliases, hot=hot))


def run(spark: SparkSession, raw: DataFrame | None = None, csv_path: str | None = None,
        processed_path: str | None = None, reports_dir: str | None = None,
        rejects_path: str | None = None, processed_format: str = "parquet",
        staging_path: str | None = None,
        margins: transform.Table = C.DEFAULT_CATEGORY_MARGINS,
        aliases: transform.Table = C.DEFAULT_CITY_ALIASES,
        versioned: bool = False, written: bool = False,
        jdbc_load: Mapping[str, object] | None = None) -> RunResult:
    """Run every stage. Give either ``raw`` (13 raw columns) or ``csv_path``.

    ``processed_path`` (and, for CSV input, ``staging_path``: the parsed lines
    as a typed table) default to fresh folders under the session's shared
    ``spark.checkpoint.dir``. Malformed lines, if there are any, go to
    ``rejects_path`` (default: the processed path with ``_rejects`` appended). A
    default staging folder is deleted once both are written, and kept if the
    rejects could not be: no line is lost. ``margins`` and ``aliases`` may be tables
    (key, value) of any size. ``versioned``: the processed table is written as a new
    version under ``processed_path`` (``sinks.versions``), so a run that fails leaves the
    last one readable. ``written``: ``raw`` is a written table, cheap to read twice (lines
    from ``csv_path`` always are one). ``jdbc_load`` (keyword arguments of
    ``sinks.jdbc.write_jdbc``: url, table, user, ...) adds the optional
    warehouse load of the processed table, the job's last step.
    """
    counts = scratch_staging = bad = None
    if raw is None:
        if csv_path is None:
            raise ValueError("give raw or csv_path")
        parsed = csv_ingest.parse_lines(csv_ingest.read_lines(spark, csv_path))
        ingest_obs = Observation("ingest")
        if staging_path is None:
            scratch_staging = staging_path = scratch_path(spark, "staged")
        raw, bad = csv_ingest.read_staged(spark, csv_ingest.write_staged(parsed, staging_path, ingest_obs, by_reason=True))
        counts = dict(ingest_obs.get)
        log.info("ingest: %s", counts)
        written = True

    stats_obs = Observation("cleaning")
    processed = process(raw, margins, aliases, stats_obs, cluster_by_month=True, written=written)
    processed_path = processed_path or scratch_path(spark, "processed")
    root = processed_path
    if versioned:
        processed_path = versions.begin(root)
    files.write_processed(processed, processed_path, processed_format, rebalance=False)
    stats = dict(stats_obs.get)
    if versioned:
        versions.commit(spark, root, processed_path, {"rows": stats["rows_after_cleaning"], "format": processed_format})
    log.info("cleaning: %s", stats)

    kept_at = None
    if bad is not None and counts["malformed_records"] > 0:
        kept_at = rejects_path or f"{root.rstrip('/')}_rejects"
        if not files.write_rejects(bad, kept_at):
            kept_at = staging_path
            log.error("%d malformed lines stay in the staging table %s", counts["malformed_records"], staging_path)
    if scratch_staging is not None and kept_at != scratch_staging:
        # Nothing reads the staged lines once the processed table and the
        # rejects are written; a staging folder the caller named is kept.
        remove_path(spark, scratch_staging)

    reader = spark.read.schema(processed.schema)
    if processed_format == "csv":
        reader = reader.options(**files.CSV_EXACT_READ)
    table = reader.format(processed_format).load(processed_path).select(*processed.columns)

    report = validation.validation_report(table).first().asDict()
    log.info("validation: %s", report)
    duplicates = report["duplicate_transaction_ids_found"]
    if duplicates:
        log.warning("%d rows of the processed table repeat a transaction id", duplicates)
    unique = duplicates == 0

    result = RunResult(table, processed_path, stats, report, counts, kept_at,
                       reports.run_aggregations(table, unique_ids=unique), sql_reports.run_all(spark, table, unique))
    if reports_dir:
        result.exported = files.export_reports(result.reports, reports_dir)
    if jdbc_load is not None:
        jdbc.write_jdbc(table, **jdbc_load)
    return result
