"""Physical-plan properties the scale design relies on."""

from rows import row

from ledgerline.operators import cleaning, reports, transform, validation
from pyspark.sql import Observation

from ledgerline.plans import catalog, pipeline, sql_reports
from ledgerline.sinks import files

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_combines_map_side_and_drops_exact_pass(raw_df):
    p = plan(cleaning.deduplicate(raw_df([row("T1")])))
    assert "partial_min" in p                     # hot keys collapse before the shuffle
    assert p.count("Exchange hashpartitioning") == 1   # exact-dedup pass removed by Catalyst
    assert "Window" not in p


def test_hot_key_third_of_rows(raw_df):
    hot = [row(None, cust=f"C{i % 7}", qty=i % 5 + 1) for i in range(300)]
    rest = [row(f"T{i}") for i in range(600)]
    d = cleaning.deduplicate(raw_df(hot + rest), keep_counts=True)
    s = cleaning.cleaning_stats(d).first()
    assert s["rows_before_cleaning"] == 900
    assert s["exact_duplicate_rows_removed"] == 900 - 600 - 35   # 35 distinct hot rows survive J1
    assert s["duplicate_transaction_ids_removed"] == 34
    survivor = d.filter("transaction_id IS NULL").first()
    assert (survivor["customer_id"], survivor["quantity"]) == ("C0", 1)


def test_reports_have_no_expand_and_combine_map_side(raw_df):
    df = validation.add_flags(transform.transform_data(cleaning.clean_data(raw_df([row("T1")]))[0]))
    for r in [f(df, unique_ids=True) for f in (reports.revenue_by_category, reports.revenue_by_state,
                                               reports.monthly_revenue_trend, reports.customer_summary)]:
        p = plan(r)
        assert "Expand" not in p and "partial_sum" in p


def test_top_k_is_take_ordered(spark):
    p = plan(catalog.q_top_products(spark, SF))
    assert "TakeOrderedAndProject" in p


def test_fact_tables_never_broadcast(spark):
    p = plan(catalog.raw(spark, SF))
    assert "SortMergeJoin" in p
    broadcast_scans = [seg for seg in p.split("BroadcastExchange")[1:] if "lineitem" in seg.split("Exchange")[0]]
    assert not broadcast_scans


def test_reports_prune_processed_table_columns(spark, tmp_path):
    df = catalog.validated(spark, SF)
    path = files.write_processed(df, str(tmp_path / "p"))
    table = spark.read.schema(df.schema).parquet(path)
    p = plan(sql_reports.run_sql(spark, "sql_delivery", table))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<delivery_days:int>" in scan
    assert "PushedFilters: [IsNotNull(delivery_days), GreaterThanOrEqual(delivery_days,0)]" in scan


def test_stats_observed_above_the_write_rebalance(spark):
    """Cleaning statistics are collected in the writing (result) stage: a map
    stage re-run after a lost executor would count them twice."""
    p = plan(pipeline.process(catalog.raw(spark, SF), stats=Observation("plan"), cluster_by_month=True))
    assert "REBALANCE_PARTITIONS_BY_COL" in p
    assert p.index("CollectMetrics") < p.index("REBALANCE_PARTITIONS_BY_COL")
    assert p.index("Filter") < p.index("CollectMetrics")   # bad dates are counted, then dropped


def test_lookups_and_misfits_start_from_a_written_table(spark):
    """Hot keys are measured, and halves split, on files: the view's joins are run once for all of it."""
    for name in ("lookup_join_split", "misfit_split"):
        assert "lineitem.parquet" not in plan(catalog.QUERIES[name](spark, SF)), name


def test_whole_rows_meet_part_before_orders(spark):
    """The part join shuffles lineitem's few numbers, not the rows with the order's texts."""
    p = catalog.raw(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in p.splitlines() if "Join Inner" in line]
    assert "o_orderkey" in joins[0] and "p_partkey" in joins[1], p


def test_a_table_by_month_is_rebalanced_once(spark, monkeypatch):
    """Its rewrite reads files of a month each and deals no row anew."""
    calls, real = [], files.rebalance_by
    monkeypatch.setattr(files, "rebalance_by", lambda df, key: calls.append(len(df.columns)) or real(df, key))
    assert catalog.q_processed_versions(spark, SF).count() > 0
    assert calls == [13]   # the raw columns, before others are derived
    assert catalog.q_processed_table(spark, SF).count() > 0
    assert calls == [13, 13]


def test_compressed_lines_are_the_same(spark):
    from ledgerline.sources import csv_ingest
    plain, packed = (catalog._csv_folder(spark, SF, c) for c in ("none", "gzip"))
    a, b = (csv_ingest.read_lines(spark, x) for x in (plain, packed))
    assert sorted(a.collect()) == sorted(b.collect())
    assert plain != packed
