"""Lookups in tables: both joins, hot and missing keys, plans on both sides of the bound."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from rows import row

from ledgerline.operators import cleaning, lookups, transform
from ledgerline.plans import pipeline
from ledgerline.sources import fixture

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def names(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v string")


@pytest.mark.parametrize("limit", [lookups.BROADCAST_BYTES, 0])
def test_every_row_once_with_hot_and_null_keys(spark, limit):
    keys = ["hot"] * 700 + [None] * 500 + [f"k{i}" for i in range(300)] + ["unknown"] * 200
    facts = spark.createDataFrame(list(enumerate(keys)), "i int, key string").repartition(6)
    table = names(spark, [("hot", "H"), (None, "never"), *[(f"k{i}", f"v{i}") for i in range(300)], ("k1", "v1")])
    found = lookups.attach(facts, lookups.prepared(table, "k"), F.col("key"), "got", limit)
    got = {r.i: r.got and r.got.v for r in found.collect()}
    want = {"hot": "H", **{f"k{i}": f"v{i}" for i in range(300)}}
    assert got == {i: want.get(k) for i, k in enumerate(keys)} and found.columns == ["i", "key", "got"]


def test_plan_on_both_sides_of_the_bound(spark):
    facts = spark.createDataFrame([(i, f"k{i % 9}") for i in range(2000)], "i int, key string")
    table = lookups.prepared(names(spark, [(f"k{i}", "v" * 100) for i in range(9)]), "k")
    assert table.rows == 9 and 9 * 102 < table.size < 9 * 160
    small = plan(lookups.attach(facts, table, F.col("key"), "got", table.size))
    large = plan(lookups.attach(facts, table, F.col("key"), "got", table.size - 1))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small and "hashpartitioning" not in small
    # only the fewer than a thousand hot keys are broadcast
    assert large.count("SortMergeJoin") == 1 and "hashpartitioning(_on" in large


def test_hot_keys_are_dealt_over_tasks(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(30000)], "i int, key string")
    hot = {r.hot_key: r.hot_salts for r in lookups.hot_keys(facts, F.col("key")).collect()}
    assert set(hot) == {"hot"} and hot["hot"] == 200
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = lookups.prepared(names(spark, [("hot", "H"), ("cold", "C")]), "k")
        joined = lookups.attach(facts, table, F.col("key"), "got", 0).withColumn("task", F.spark_partition_id())
        counts = [r["count"] for r in joined.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(counts) == 8 and max(counts) < 2 * 30000 / 8


def test_torn_lookup_is_an_error(spark):
    with pytest.raises(ValueError, match="1 keys"):
        lookups.prepared(names(spark, [("a", "1"), ("a", "2"), ("b", "1"), ("b", "1")]), "k")
    with pytest.raises(ValueError, match="value column"):
        lookups.prepared(spark.createDataFrame([("a",)], "k string"), "k")
    empty = lookups.prepared(names(spark, []), "k")
    assert (empty.rows, empty.size) == (0, 0)


@pytest.mark.parametrize("limit", [lookups.BROADCAST_BYTES, 0])
def test_tables_equal_literal_maps(spark, raw_df, limit):
    rows = [row("T1", cat="garden", city="poona"), row("T2", cat=None, city=None), row("T3", cat="  TOYS ", city="Delhi"),
            row("T4", cat="garden", city="x")]
    clean = cleaning.clean(raw_df(rows))
    margins, aliases = {"Garden": "0.5", "Toys": "0.125"}, {"Poona": "Pune", "Unknown City": "Nowhere"}
    tables = names(spark, list(margins.items())), names(spark, list(aliases.items()))
    want = transform.transform_data(clean, margins, aliases)
    got = transform.transform_data(clean, *tables, limit=limit)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(got.collect()) == sorted(want.collect())
    assert {r.transaction_id: r.profit_margin for r in got.collect()}["T2"] == D("0.15")


def test_run_takes_tables(spark, tmp_path, monkeypatch):
    """Also with lookups too large to broadcast, whose hot keys are measured before the observed frame runs."""
    from ledgerline.functions import columns as C
    margins, aliases = names(spark, list(C.DEFAULT_CATEGORY_MARGINS.items())), names(spark, list(C.DEFAULT_CITY_ALIASES.items()))
    raw = fixture.sales_raw(spark, SF)
    want = pipeline.run(spark, raw=raw, processed_path=str(tmp_path / "a"))
    monkeypatch.setattr(lookups.Lookup, "small", lambda self, limit: False)
    got = pipeline.run(spark, raw=raw, processed_path=str(tmp_path / "b"), margins=margins, aliases=aliases)
    assert got.cleaning_stats == want.cleaning_stats and got.validation_report == want.validation_report
    assert sorted(got.processed.collect(), key=str) == sorted(want.processed.collect(), key=str)
