"""The corpus pipeline: stages over the documents table, each calling one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is
written as Parquet and read again as the next stage's docs. All stages but the
last return the columns of ``documents``.

Defined results, for every stage: nulls are allowed in any column, texts of any
length are handled whole, an empty table gives an empty table, extra columns
are kept (except by the last stage), repeated rows are treated alike. A row with
a null or letterless text has no language and goes in the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm import decontaminate, language, mixing, simhash, token_files
from ledgerline.session import scratch_path

LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: rejects texts without a letter, and those
    of which no language has at least ``LEAST_SCORE``. Learns from the labelled rows
    whose crc32 of the id is not 2 modulo 4, as op3 does."""
    model = language.train(docs.filter(C.id_bucket("doc_id", 4) != 2))
    found = docs.select(F.struct("*").alias("row"), language.predict(docs, model).alias("found"))
    return found.filter((F.col("found.lang") != language.UNKNOWN) & (F.col("found.score") >= LEAST_SCORE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one of the least id. Ids may repeat
    with different texts: a text goes only if a near duplicate of it stays."""
    return simhash.one_of_each(docs, one_per_id=False)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an exact match of a benchmark window. Proximity matches are not
    acted on; op10_proximity reports them."""
    return decontaminate.clean_documents(docs, C.table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document comes as often as it is taken, in complete epochs of its
    source and in the fractional selection."""
    mixed = mixing.mix(docs)
    copies = F.sequence(F.lit(1), F.col("mix.copies"))
    return (mixed.filter("mix.copies > 0").select("row", F.explode(copies).alias("copy")).select("row.*"))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 per row."""
    path = token_files.write(docs, scratch_path(spark, "corpus-tokens"), public_tokenizers.path("byte_bpe_50k.json"))
    sums = token_files.read_tokens(spark, path).select("row_no", token_files.ids_crc32("tokens").alias("ids_crc32"))
    return token_files.read_index(spark, path).join(sums, "row_no").select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

# Naive Bayes, SimHash (XXH64) and a tokenizer can't be said in SQL: the stages are
# tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
