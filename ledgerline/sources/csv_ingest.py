"""Fixed-schema CSV ingest with corrupt-line routing.

Lines are read as text and parsed with ``from_csv`` in PERMISSIVE mode. The
CSV file source converts only the columns a query needs, so which lines are
"corrupt" would change with the projection (a count that touches only the
corrupt column even fails). Parsing the whole line in one expression makes
the split independent of column pruning and needs no cache. The first line of
every file is its header, whatever it says. Limit: no multi-line quoted fields.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schema import CORRUPT, RAW_COLUMNS, REASONS, raw_ddl, raw_schema


MALFORMED = "_malformed"  # partition column of the staging table


@dataclass
class Ingested:
    """Good rows (13 typed columns), bad lines (raw text) and the one-row counts."""
    good: DataFrame
    bad: DataFrame
    counts: DataFrame


# A character that separates nothing: a line is one field. A line that does hold it
# comes whole in the corrupt column.
NO_SEPARATOR = "\x01"
WHOLE_SCHEMA = "value string, _whole string"
WHOLE_LINES = {"header": "true", "sep": NO_SEPARATOR, "quote": "", "columnNameOfCorruptRecord": "_whole", "mode": "PERMISSIVE"}


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines of one or many CSV files without each file's first line, its header
    (column ``value``). The CSV reader knows where a file begins, the text reader doesn't."""
    whole = spark.read.options(**WHOLE_LINES).schema(WHOLE_SCHEMA)
    return whole.csv(path).select(F.coalesce("_whole", "value").alias("value"))


def parse_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S3: parse each line against the fixed schema; unparseable lines keep
    their text in ``_corrupt_record`` (bad cast, too few or too many fields) and
    say why in ``_reasons``. Blank fields are NULL and are not corrupt; leading
    spaces are kept. The line is parsed once: ``inline`` yields the parsed fields as
    columns, where a filter and a projection over a struct would each parse."""
    v = F.col(value_col)
    kept = lines.filter(F.length(F.trim(v)) > 0)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = kept.select(F.inline(F.array(F.from_csv(v, raw_ddl(with_corrupt=True), opts))))
    return parsed.withColumn(REASONS, F.when(F.col(CORRUPT).isNotNull(), reject_reasons(CORRUPT)))


# What a reject's reason can begin with; the last three are followed by the column.
TOO_FEW, TOO_MANY, UNREADABLE = "too_few_fields", "too_many_fields", "unreadable"
NOT_A_NUMBER, NOT_AN_INTEGER, TOO_WIDE = "not_a_number", "not_an_integer", "too_wide"
REASON_KINDS = [TOO_FEW, TOO_MANY, NOT_A_NUMBER, NOT_AN_INTEGER, TOO_WIDE, UNREADABLE]
WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
MARK = "\x01"   # a field added behind a line's own, to see whether they are too few


def reject_reasons(line: str) -> Column:
    """Why a line that holds no row of the fixed schema doesn't, as an array of codes:
    its number of fields, else each column whose value is no number, no
    integer, or too wide for its type; ``unreadable`` if a quote stays open or none of
    these is the case.

    The line is split again, into texts, but only where this is evaluated
    (malformed lines). Fields of a line with a wrong number of fields may be
    shifted, so their values say nothing."""
    ddl = ", ".join(f"`{c}` string" for c in RAW_COLUMNS)
    own = F.from_csv(F.col(line), f"{ddl}, `{CORRUPT}` string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    marked = F.from_csv(F.concat(F.col(line), F.lit(f",{MARK}" * len(RAW_COLUMNS))), ddl, {"mode": "PERMISSIVE"})
    open_quote = (F.length(line) - F.length(F.replace(F.col(line), F.lit('"'), F.lit("")))) % 2 == 1

    def wrong(field, r: Column) -> Column:
        v, kind = r[field.name], field.dataType
        code = lambda k: F.lit(f"{k}:{field.name}")
        if isinstance(kind, T.IntegerType):
            return (F.when(v.isNull(), None).when(~v.rlike(NUMBER), code(NOT_A_NUMBER)).when(~v.rlike(WHOLE), code(NOT_AN_INTEGER))
                    .when(v.try_cast(kind).isNull(), code(TOO_WIDE)))
        plain = F.replace(v, F.lit(","), F.lit(""))   # the CSV reader takes grouped digits
        return F.when(v.isNull(), None).when(~plain.rlike(NUMBER), code(NOT_A_NUMBER)).when(plain.try_cast(kind).isNull(), code(TOO_WIDE))

    numeric = [f for f in raw_schema().fields if not isinstance(f.dataType, T.StringType)]
    found = lambda r: F.array_compact(F.array(*[wrong(f, r) for f in numeric]))
    fields = F.when(marked[RAW_COLUMNS[-1]] == MARK, F.array(F.lit(TOO_FEW))).otherwise(F.array(F.lit(TOO_MANY)))
    # the one element of an array, so that the fields are split once for all their uses
    codes = F.transform(F.array(own), lambda r: F.when(r[CORRUPT].isNotNull(), fields).otherwise(found(r)))[0]
    return F.when(open_quote | (F.size(codes) == 0), F.array(F.lit(UNREADABLE))).otherwise(codes)


def reason_kind(reason: Column) -> Column:
    return F.substring_index(reason, ":", 1)


def has_reason(kind: str) -> Column:
    return F.exists(REASONS, lambda r: reason_kind(r) == kind)


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad raw lines with their reasons)."""
    good = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, REASONS)
    bad = parsed.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, REASONS)
    return good, bad


def count_columns(by_reason: bool = False) -> list[Column]:
    """S6 as aggregate expressions (usable in ``agg`` and ``observe``); ``by_reason`` adds the
    malformed lines by kind of reason (a line with several counts in each)."""
    reasons = REASON_KINDS if by_reason else []
    return [
        F.count(F.lit(1)).cast("bigint").alias("total_records"),
        F.count_if(F.col(CORRUPT).isNotNull()).cast("bigint").alias("malformed_records"),
        F.count_if(F.col(CORRUPT).isNull()).cast("bigint").alias("usable_records"),
        *[F.count_if(has_reason(kind)).cast("bigint").alias(f"{kind}_records") for kind in reasons],
    ]


def ingest_counts(parsed: DataFrame, by_reason: bool = False) -> DataFrame:
    """Total, malformed and usable line counts in one pass."""
    return parsed.agg(*count_columns(by_reason))


def write_staged(parsed: DataFrame, path: str, counts: Observation | None = None, by_reason: bool = False) -> str:
    """Write the parsed lines once as a typed parquet staging table, partitioned
    by ``_malformed`` (good rows and bad lines in separate folders).

    The job is scan -> parse -> write with no shuffle, so ``counts`` (S6) is
    observed in its result stage, where Spark merges each partition's metrics
    once even if tasks or executors are lost. Observed in a map stage that
    feeds a shuffle (the dedup), a re-run after a lost executor would count
    lines twice. Later stages read the staging table (lineage cut: a failure
    costs a parquet re-read, not a CSV re-parse).
    """
    if counts is not None:
        parsed = parsed.observe(counts, *count_columns(by_reason))
    flagged = parsed.withColumn(MALFORMED, F.col(CORRUPT).isNotNull())
    flagged.write.mode("overwrite").partitionBy(MALFORMED).parquet(path, compression="zstd")
    return path


def read_staged(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines) of a staging table; each side reads only its own
    partition folder."""
    schema = T.StructType(raw_schema().fields + [T.StructField(CORRUPT, T.StringType()),
                                                 T.StructField(REASONS, T.ArrayType(T.StringType())),
                                                 T.StructField(MALFORMED, T.BooleanType())])
    staged = spark.read.schema(schema).parquet(path)
    good = staged.filter(~F.col(MALFORMED)).select(*RAW_COLUMNS)
    bad = staged.filter(F.col(MALFORMED)).select(CORRUPT, REASONS)
    return good, bad


def ingest_lines(lines: DataFrame) -> Ingested:
    """S3 + S5 + S6 for lines without a header."""
    parsed = parse_lines(lines)
    good, bad = split_parsed(parsed)
    return Ingested(good, bad, ingest_counts(parsed))


def ingest_csv(spark: SparkSession, path: str | list[str]) -> Ingested:
    """S3 + S5 + S6 for CSV files with a header line."""
    return ingest_lines(read_lines(spark, path))


def infer_schema_preview(spark: SparkSession, path: str, sampling_ratio: float = 0.05) -> DataFrame:
    """What type inference makes of a sample, as ``(column, inferred_type)``
    rows. Exploration only; the ingest path always uses the fixed schema."""
    inferred = (spark.read.option("header", True).option("inferSchema", True)
                .option("samplingRatio", sampling_ratio).csv(path)).schema
    rows = [(f.name, f.dataType.simpleString()) for f in inferred.fields]
    return spark.createDataFrame(rows, "column string, inferred_type string")


# --- S4 on all rows: a lattice of types ------------------------------------------------------

PLAIN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
CLASSES = ["int", "bigint", "decimal", "double", "date", "string"]
MAX_DIGITS = 38


def text_fields(lines: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The fields of CSV lines as text; an absent or empty field is NULL."""
    ddl = ", ".join(f"`{c}` string" for c in columns or RAW_COLUMNS)
    return lines.select(F.inline(F.array(F.from_csv("value", ddl, {"mode": "PERMISSIVE"}))))


def value_class(v: Column) -> Column:
    """The least type of ``CLASSES`` that holds a text exactly."""
    return (F.when(v.rlike(WHOLE) & v.try_cast("int").isNotNull(), "int").when(v.rlike(WHOLE) & v.try_cast("bigint").isNotNull(), "bigint")
            .when(v.rlike(PLAIN), "decimal").when(v.rlike(NUMBER), "double")
            .when(v.rlike(ISO_DATE) & F.try_to_date(v, "yyyy-MM-dd").isNotNull(), "date").otherwise("string"))


def infer_types(texts: DataFrame) -> DataFrame:
    """The type of each text column from all of its values: column, inferred_type, n_null,
    and the number of values of each class (n_int ... n_string).

    A column's type is the join of its values' in the lattice null < int < bigint <
    decimal(p, s) < double < string, date < string. Sums and maxima decide it, so
    tasks hand on one row per column and the result doesn't depend on how
    the input is cut. Decimals get the most digits before and behind the point that
    occur; over 38 in all make a double."""
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"`{c}`").alias("v"))
                      for i, c in enumerate(texts.columns)])
    values = texts.select(F.inline(pairs)).withColumn("kind", F.when(F.col("v").isNotNull(), value_class(F.col("v"))))
    exact = F.col("kind").isin("int", "bigint", "decimal")
    whole = F.length(F.regexp_replace(F.substring_index("v", ".", 1), "^[+-]?0*", ""))
    behind = F.when(F.contains("v", F.lit(".")), F.length(F.substring_index("v", ".", -1))).otherwise(0)
    found = values.groupBy("position", "column").agg(
        F.count_if(F.col("v").isNull()).alias("n_null"), F.count("v").alias("n"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in CLASSES],
        F.max(F.when(exact, whole)).alias("whole"), F.max(F.when(exact, behind)).alias("behind"))
    digits = F.greatest(F.lit(1), F.col("whole") + F.col("behind"))
    kind = (F.when(F.col("n") == 0, "null").when(F.col("n_date") == F.col("n"), "date")
            .when((F.col("n_string") > 0) | (F.col("n_date") > 0), "string").when(F.col("n_double") > 0, "double")
            .when((F.col("n_decimal") > 0) & (digits > MAX_DIGITS), "double")
            .when(F.col("n_decimal") > 0, F.format_string("decimal(%d,%d)", digits, F.col("behind")))
            .when(F.col("n_bigint") > 0, "bigint").otherwise("int"))
    return found.select("column", kind.alias("inferred_type"), "n_null", *[f"n_{k}" for k in CLASSES])


def infer_csv_types(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """S4 over the whole of one or many CSV files with a header line."""
    return infer_types(text_fields(read_lines(spark, path), columns))


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read an exported report back (header line; fixed schema if given)."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


__all__ = ["Ingested", "read_lines", "parse_lines", "split_parsed", "ingest_counts",
           "reject_reasons", "write_staged", "read_staged",
           "ingest_lines", "ingest_csv", "infer_schema_preview", "read_report_csv", "raw_schema"]
