"""One Spark query per operator, each over the fixture view of a table folder.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose work grows
with the driver's tables; lazy, but for those whose feature is a written file or
the whole run, which write it first. Column names and types match the SQL
twins in ``ledgerline.checks.oracle_queries``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import cleaning, lookups, reports, rollup, transform, validation
from ledgerline.plans import pipeline, sql_reports
from ledgerline.schema import RAW_COLUMNS
from ledgerline.session import scratch_path
from ledgerline.sinks import files, jdbc, versions
from ledgerline.sources import csv_ingest, fixture
from ledgerline.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]


# ``validated`` is grouped by transaction id, so its ids are unique (``uniqueness_check``
# and ``validation_report`` measure it).
UNIQUE = True


# --- stage frames --------------------------------------------------------------

def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.sales_raw(spark, sf)


def derived_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """``derived`` for a write by month: rows are clustered before columns are added to them."""
    return transform.transform_data(files.rebalance_by(cleaned(spark, sf), C.order_year_month("order_date")))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: what is before it runs once, however often it is read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deduped(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.deduplicate(raw(spark, sf))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean(raw(spark, sf))


def derived(spark: SparkSession, sf: str) -> DataFrame:
    return transform.transform_data(cleaned(spark, sf))


def validated(spark: SparkSession, sf: str) -> DataFrame:
    return validation.add_flags(derived(spark, sf))


# --- sources ---------------------------------------------------------------------

def _csv_folder(spark: SparkSession, sf: str, compression: str = "none") -> str:
    """The fixture rendered as CSV files in the shared checkpoint folder, once for a
    session, table folder and compression."""
    key = (spark.sparkContext.applicationId, sf, compression)
    if key not in _RENDERED:
        _RENDERED[key] = fixture.write_sales_csv(spark, sf, scratch_path(spark, "sales-csv"), compression)
    return _RENDERED[key]


_RENDERED: dict[tuple[str, str, str], str] = {}


def _ingested(spark: SparkSession, sf: str) -> csv_ingest.Ingested:
    return csv_ingest.ingest_lines(fixture.sales_csv_lines(spark, sf))


def q_csv_routing(spark, sf):
    return _ingested(spark, sf).good


def q_ingest_counts(spark, sf):
    """S6 with the malformed lines by reason."""
    return csv_ingest.ingest_counts(csv_ingest.parse_lines(fixture.sales_csv_lines(spark, sf)), by_reason=True)


def q_malformed_lines(spark, sf):
    """K1 round trip: bad lines written by the reject sink, read back with their reasons."""
    path = scratch_path(spark, "rejects")
    if not files.write_rejects(_ingested(spark, sf).bad, path):
        raise OSError(f"rejects not written to {path}")
    return files.read_rejects(spark, path).select(F.col("value").alias("malformed_line"), "reason")


def q_schema_preview(spark, sf):
    """The types of the CSV files' columns, inferred from every value."""
    return csv_ingest.infer_csv_types(spark, _csv_folder(spark, sf)).withColumnRenamed("column", "column_name")


def q_numeric_parse(spark, sf):
    """T10 over the CSV text: every field as text, then tolerant numeric parse."""
    fields = csv_ingest.text_fields(fixture.sales_csv_lines(spark, sf))
    return fields.select(
        "transaction_id",
        F.col("quantity").alias("quantity_text"),
        C.numeric_parse("quantity").alias("quantity_num"),
        C.numeric_parse("unit_price").alias("unit_price_num"),
    )


# --- cleaning --------------------------------------------------------------------

def q_dedup_exact(spark, sf):
    return cleaning.drop_exact_duplicates(raw(spark, sf))


def q_dedup_key(spark, sf):
    return deduped(spark, sf)


def q_impute_defaults(spark, sf):
    return cleaning.impute_defaults(deduped(spark, sf))


def q_abs_quantity(spark, sf):
    return cleaning.correct_quantity(deduped(spark, sf))


def q_parse_dates(spark, sf):
    return cleaning.parse_dates(deduped(spark, sf))


def q_cleaning_stats(spark, sf):
    return cleaning.clean_data(raw(spark, sf))[1]


# --- transform -------------------------------------------------------------------

def q_standardize_category(spark, sf):
    return transform.standardize_category(cleaned(spark, sf))


def q_normalize_city(spark, sf):
    return transform.normalize_city(cleaned(spark, sf))


def q_derive_money(spark, sf):
    return derived(spark, sf).select("transaction_id", "revenue", "profit_margin", "profit")


def lookup_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lookups derived from the driver's tables: margin by category, city aliases, products."""
    part = fixture.table(spark, sf, "part", "p_partkey bigint, p_type string, p_brand string, p_size int")
    category = F.expr("CASE " + " ".join(f"WHEN p_type = '{k}' THEN '{v}'" for k, v in fixture.PART_TYPE_CATEGORY.items())
                      + f" ELSE '{fixture.OTHER_CATEGORY}' END")
    margins = part.groupBy(category.alias("category")).agg(
        ((F.count(F.lit(1)) % 40 + 5).cast("decimal(9,0)") * Decimal("0.01")).cast("decimal(9,6)").alias("margin"))
    nation = fixture.table(spark, sf, "nation", "n_name string, n_regionkey int")
    aliases = nation.select(F.initcap("n_name").alias("city"), F.concat(F.initcap("n_name"), F.lit(" "), "n_regionkey").alias("alias"))
    products = part.select(F.expr(f"concat('PROD', {fixture.padded('p_partkey', 7)})").alias("product_id"), "p_brand", "p_size")
    return margins, aliases, products


def _lookup_join(limit: int) -> Query:
    def q(spark, sf):
        margins, aliases, products = (lookups.as_lookup(t) for t in lookup_tables(spark, sf))
        # what the joins need, written: hot keys are measured on it, not on frames that run the view and the joins before again
        facts = written(cleaned(spark, sf).select(
            "transaction_id", "product_id", "category", "city", "quantity", "unit_price", "discount", "order_date", "delivery_date"), "facts")
        hot = transform.hot_lookup_keys(facts, margins, aliases, limit)
        hot_products = None if products.small(limit) else lookups.hot_keys(facts, F.col("product_id"))
        sales = (transform.transform_data(facts, margins, aliases, limit=limit, hot=hot)
                 .select("transaction_id", "product_id", "category", "city", "profit_margin", "profit"))
        return (lookups.attach(sales, products, F.col("product_id"), "product", limit, hot_products)
                .select("transaction_id", "category", "city", "profit_margin", "profit", "product.p_brand", "product.p_size"))
    q.__name__ = "q_lookup_join"
    return q


def q_derive_dates(spark, sf):
    return derived(spark, sf).select("transaction_id", "delivery_days", "order_month",
                                     "order_year", "order_year_month")


def q_city_label(spark, sf):
    return transform.city_labels(derived(spark, sf)).select("transaction_id", "city", "state", "city_label")


# --- validation ------------------------------------------------------------------

def q_uniqueness_check(spark, sf):
    return validation.uniqueness_check(derived(spark, sf))


def q_revenue_flag(spark, sf):
    return validated(spark, sf).select("transaction_id", "total_amount", "revenue", "revenue_consistent")


def q_date_flag(spark, sf):
    return validated(spark, sf).select("transaction_id", "order_date", "delivery_date", "date_integrity_ok")


def q_validation_report(spark, sf):
    return validation.validate_data(derived(spark, sf))[1]


def q_quality_profile(spark, sf):
    return validation.quality_profile(raw(spark, sf))


# --- reports ---------------------------------------------------------------------

def q_sales_kpis(spark, sf):
    return reports.sales_kpis(validated(spark, sf), unique_ids=UNIQUE)


def q_avg_delivery(spark, sf):
    return reports.average_delivery_time(validated(spark, sf))


def q_revenue_by_category(spark, sf):
    return reports.revenue_by_category(validated(spark, sf), unique_ids=UNIQUE)


def q_revenue_by_state(spark, sf):
    return reports.revenue_by_state(validated(spark, sf), unique_ids=UNIQUE)


def q_monthly_trend(spark, sf):
    return reports.monthly_revenue_trend(validated(spark, sf), unique_ids=UNIQUE)


def q_top_products(spark, sf):
    return reports.top_products(validated(spark, sf))


def q_top_cities(spark, sf):
    return reports.top_cities_by_revenue(validated(spark, sf))


def q_rollup_kpis(spark, sf):
    """A1 over the raw view's rows (ids repeat there), distinct counts from bitmaps."""
    return rollup.sales_kpis(repeated(spark, sf))


def q_rollup_by_state(spark, sf):
    """A4 in the same way."""
    return rollup.revenue_by_state(repeated(spark, sf))


def repeated(spark: SparkSession, sf: str) -> DataFrame:
    """The raw view with revenue, not deduplicated."""
    rows = cleaning.impute_defaults(raw(spark, sf))
    return rows.select("transaction_id", "customer_id", "state", C.revenue(F.abs("quantity")).alias("revenue"))


def q_customer_summary(spark, sf):
    return reports.customer_summary(validated(spark, sf), unique_ids=UNIQUE)


def q_kpi_long(spark, sf):
    return reports.kpi_long(reports.sales_kpis(validated(spark, sf), unique_ids=UNIQUE, with_delivery=True))


def _sql(name: str) -> Query:
    def q(spark, sf):
        return sql_reports.run_sql(spark, name, validated(spark, sf), unique_ids=UNIQUE)
    q.__name__ = f"q_{name}"
    return q


# --- sinks -----------------------------------------------------------------------

def q_processed_table(spark, sf):
    """K2 round trip: the processed table written partitioned, read back."""
    df = validation.add_flags(derived_by_month(spark, sf))
    path = files.write_processed(df, scratch_path(spark, "processed"), rebalance=False)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def q_processed_versions(spark, sf):
    """K2 in versions: the table written, rewritten from itself (its flags made anew), and read
    through the manifest. A version's files hold a month each, so its rewrite needs no rebalance."""
    path, df = scratch_path(spark, "versions"), derived_by_month(spark, sf)
    versions.write_version(df, path, rebalance=False)
    again = validation.add_flags(versions.read_current(spark, path, df.schema))
    versions.write_version(again, path, rebalance=False)
    versions.prune(spark, path, keep=1)
    return versions.read_current(spark, path, again.schema)


def q_misfit_split(spark, sf):
    """K5: what the warehouse can hold, and the rows it can't."""
    fits, misfits = jdbc.split_misfits(written(validated(spark, sf), "validated"))   # both halves start from files
    label = lambda df, why: df.select("transaction_id", F.col("revenue").cast("string").alias("revenue"), why.alias("misfit_columns"))
    return label(fits, F.lit("")).unionByName(label(misfits, F.col("misfit_columns")))


def q_report_roundtrip(spark, sf):
    """K3 + S7 round trip: the category report exported as CSV and read back."""
    df = reports.revenue_by_category(validated(spark, sf), unique_ids=UNIQUE)
    path = files.write_report(df, scratch_path(spark, "category_sales"), single_file=True)
    return csv_ingest.read_report_csv(spark, path, df.schema)


# --- the end-to-end run ------------------------------------------------------------

def _csv_run(spark: SparkSession, sf: str) -> pipeline.RunResult:
    return pipeline.run(spark, csv_path=_csv_folder(spark, sf, "gzip"))


def q_pipeline_stats(spark, sf):
    """What the run from CSV text reports of itself: (stage, measure, value)."""
    res = _csv_run(spark, sf)
    rows = [(stage, k, None if v is None else Decimal(v))
            for stage, d in (("ingest", res.ingest_counts), ("cleaning", res.cleaning_stats),
                             ("validation", res.validation_report)) for k, v in d.items()]
    return spark.createDataFrame(rows, "stage string, measure string, value decimal(38,2)")


def q_pipeline_csv_reports(spark, sf):
    """Four reports of the run from CSV text, one under the other."""
    res = _csv_run(spark, sf)
    parts = [res.reports[name].select(F.lit(label).alias("report"), F.col(key).alias("name"), "total_revenue", "total_orders")
             for label, name, key in (("category", "revenue_by_category", "category"), ("state", "revenue_by_state", "state"),
                                      ("month", "monthly_revenue_trend", "order_year_month"),
                                      ("customer", "customer_summary", "customer_id"))]
    return functools.reduce(DataFrame.unionByName, parts)


def q_incremental_reports(spark, sf):
    """The category report of an incremental run that takes the CSV files in several micro-batches."""
    res = incremental.run_new(spark, _csv_folder(spark, sf), scratch_path(spark, "incremental"), max_files=2)
    return res.reports["revenue_by_category"]


QUERIES: dict[str, Query] = {
    "csv_routing": q_csv_routing,
    "ingest_counts": q_ingest_counts,
    "malformed_lines": q_malformed_lines,
    "schema_preview": q_schema_preview,
    "numeric_parse": q_numeric_parse,
    "dedup_exact": q_dedup_exact,
    "dedup_key": q_dedup_key,
    "impute_defaults": q_impute_defaults,
    "abs_quantity": q_abs_quantity,
    "parse_dates": q_parse_dates,
    "cleaning_stats": q_cleaning_stats,
    "standardize_category": q_standardize_category,
    "normalize_city": q_normalize_city,
    "derive_money": q_derive_money,
    "lookup_join": _lookup_join(lookups.BROADCAST_BYTES),
    "lookup_join_split": _lookup_join(0),
    "derive_dates": q_derive_dates,
    "city_label": q_city_label,
    "uniqueness_check": q_uniqueness_check,
    "revenue_flag": q_revenue_flag,
    "date_flag": q_date_flag,
    "validation_report": q_validation_report,
    "quality_profile": q_quality_profile,
    "sales_kpis": q_sales_kpis,
    "avg_delivery": q_avg_delivery,
    "revenue_by_category": q_revenue_by_category,
    "revenue_by_state": q_revenue_by_state,
    "monthly_trend": q_monthly_trend,
    "top_products": q_top_products,
    "top_cities": q_top_cities,
    "rollup_kpis": q_rollup_kpis,
    "rollup_by_state": q_rollup_by_state,
    "customer_summary": q_customer_summary,
    "kpi_long": q_kpi_long,
    **{name: _sql(name) for name in sql_reports.SQL},
    "processed_table": q_processed_table,
    "processed_versions": q_processed_versions,
    "misfit_split": q_misfit_split,
    "report_roundtrip": q_report_roundtrip,
    "pipeline_stats": q_pipeline_stats,
    "pipeline_csv_reports": q_pipeline_csv_reports,
    "incremental_reports": q_incremental_reports,
}
