"""Keys that hold a third of all rows are dealt over many tasks, and nothing is lost."""

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm import simhash, token_files, warc
from ledgerline.session import scratch_path


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_split_equals_a_plain_join(spark, how):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 40).cast("bigint")
    left = C.written(spark.range(6000).select(F.col("id").alias("n"), key.alias("k")), "hot-left")
    right = C.written(spark.range(30).select(F.col("id").alias("r"), (F.col("id") * 2).alias("v")), "hot-right")
    got = C.join_split(left, right, "k", "r", left.count(), how)
    plain = left.join(right, F.col("k") == F.col("r"), how)
    assert got.columns == plain.columns
    assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)


def test_a_hot_key_is_spread(spark):
    left = C.written(spark.range(5000).select("id", F.lit(1).cast("bigint").alias("k")), "hot-left")
    right = spark.range(1, 2).select(F.col("id").alias("r"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        tasks = C.join_split(left, right, "k", "r", 5000).groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in tasks) == 5000
    assert max(r["count"] for r in tasks) < 2500


def test_great_star(spark):
    """One component with a middle that most links share, another that is a chain."""
    star = [(0, i) for i in range(1, 400)]
    chain = [(1000 + i, 1001 + i) for i in range(30)]
    edges = spark.createDataFrame(star + chain, "a bigint, b bigint")
    got = {r.node: r.root for r in simhash.connected(edges).collect()}
    assert got == {i: 0 for i in range(1, 400)} | {1001 + i: 1000 for i in range(30)}


def test_one_id_in_most_rows(spark):
    docs = spark.createDataFrame([(5, f"one id with text {i % 50} of many") for i in range(600)] + [(6, "another text")],
                                 "doc_id bigint, text string")
    kept = simhash.one_of_each(docs).collect()
    assert sorted(r.doc_id for r in kept) == [5, 6]
    import public_tokenizers
    path = token_files.write(docs, scratch_path(spark, "hot-tokens"), public_tokenizers.path("byte_bpe_50k.json"))
    rows = token_files.read_index(spark, path).orderBy("row_no").collect()
    assert [r.doc_id for r in rows] == [5] * 600 + [6]
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(len(rows))]


def test_a_response_that_all_ask_for(spark):
    head, seen = 'HTTP/1.1 200 OK\r\nETag: "a"', 'HTTP/1.1 304 Not Modified\r\nETag: "a"'
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id"))
    log = spark.range(600).select(
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("record_id"), F.lit("http://a.com/").alias("target_uri"),
        at.alias("warc_date"), F.when(F.col("id") == 0, "response").otherwise("revisit").alias("warc_type"),
        F.when(F.col("id") == 0, head).otherwise(seen).alias("http_head"),
        F.when(F.col("id") == 0, "page").alias("payload"))
    got = warc.resolve(log).collect()
    assert len(got) == len({r.record_id for r in got}) == 599
    assert {(r.status, r.response_id, r.payload) for r in got} == {("resolved", "r0", "page")}
