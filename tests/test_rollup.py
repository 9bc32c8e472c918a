"""Distinct counts from bitmaps against COUNT DISTINCT, merged over groups and batches."""

import random
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerline.operators import reports, rollup

SCHEMA = "transaction_id string, customer_id string, state string, revenue decimal(27,2)"


def sales(spark, seed, n):
    rng = random.Random(seed)
    rows = [(rng.choice([None, f"T{rng.randint(1, n // 2)}"]), rng.choice([None, "GUEST", f"C{rng.randint(1, n // 3)}"]),
             rng.choice([None, "S1", "S2", "S3"]), D(rng.randint(0, 10 ** 6)) / 100) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_reports_equal_count_distinct_without_expand(spark):
    df = sales(spark, 1, 900)
    bitmaps = rollup.state_bitmaps(df)
    for mine, theirs in ((rollup.revenue_by_state(df, bitmaps), reports.revenue_by_state(df)),
                         (rollup.sales_kpis(df, bitmaps), reports.sales_kpis(df))):
        assert mine.dtypes == theirs.dtypes and mine.collect() == theirs.collect()
        assert "Expand" not in mine._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in reports.revenue_by_state(df)._jdf.queryExecution().executedPlan().toString()


def test_batches_merge_under_an_extended_dictionary(spark):
    a, b = sales(spark, 2, 400), sales(spark, 3, 600)
    codes = rollup.id_codes(a, "customer_id")
    first = rollup.id_bitmaps(a, "customer_id", ["state"], codes)
    longer = rollup.id_codes(b, "customer_id", old=codes)
    both = first.unionByName(rollup.id_bitmaps(b, "customer_id", ["state"], longer))
    ids = longer.agg(F.count("id"), F.count_distinct("id"), F.count_distinct("code")).first()
    assert len(set(ids)) == 1
    rows = a.unionByName(b)
    want = rows.groupBy("state").agg(F.count_distinct("customer_id").alias("n"))
    assert sorted(rollup.counted(both, ["state"], "n").collect(), key=str) == sorted(want.collect(), key=str)
    assert rollup.counted(both, [], "n").first().n == rows.select(F.count_distinct("customer_id")).first()[0]


def test_many_ids_take_several_bitmaps(spark):
    df = spark.range(3 * rollup.BITS + 5).select(F.col("id").cast("string").alias("customer_id"), F.lit("S").alias("state"))
    bitmaps = rollup.id_bitmaps(df.coalesce(1), "customer_id", ["state"], rollup.id_codes(df, "customer_id"))
    assert bitmaps.count() >= 4 and rollup.counted(bitmaps, ["state"], "n").first().n == 3 * rollup.BITS + 5


def test_no_rows(spark):
    none = sales(spark, 1, 10).filter("false")
    assert rollup.revenue_by_state(none).count() == 0
    assert rollup.sales_kpis(none).collect() == reports.sales_kpis(none).collect()
