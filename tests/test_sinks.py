from rows import row

from ledgerline.operators import cleaning, reports, transform, validation
from ledgerline.sinks import files, jdbc
from ledgerline.sources import csv_ingest


def validated(raw_df, rows):
    return validation.add_flags(transform.transform_data(cleaning.clean_data(raw_df(rows))[0]))


def test_processed_roundtrip_partitioned(spark, raw_df, tmp_path):
    df = validated(raw_df, [row("T1"), row("T2", od="2024-02-03", dd="2024-02-05")])
    p = files.write_processed(df, str(tmp_path / "processed"))
    back = spark.read.schema(df.schema).parquet(p).select(*df.columns)
    assert sorted(back.collect()) == sorted(df.collect())
    assert {d.name for d in (tmp_path / "processed").iterdir() if d.is_dir()} == {
        "order_year_month=2024-01", "order_year_month=2024-02"}


def test_partitioned_write_is_clustered_by_month(spark, raw_df, tmp_path):
    rows = [row(f"T{i}", od=f"2024-0{i % 2 + 1}-03", dd="2024-03-05") for i in range(40)]
    df = validated(raw_df, rows).repartition(8)
    files.write_processed(df, str(tmp_path / "processed"))
    for month in ["order_year_month=2024-01", "order_year_month=2024-02"]:
        parts = [f for f in (tmp_path / "processed" / month).iterdir() if f.name.endswith(".parquet")]
        assert len(parts) == 1, month     # not one file per write task


def test_export_reports(spark, raw_df, tmp_path):
    df = validated(raw_df, [row(f"T{i}", cat=["A", "B"][i % 2]) for i in range(6)])
    written = files.export_reports(reports.run_aggregations(df), str(tmp_path / "reports"))
    assert set(written) == {"kpi_summary", "revenue_by_category", "revenue_by_state", "monthly_revenue_trend",
                            "top_products", "top_cities", "customer_summary"}
    cat = csv_ingest.read_report_csv(spark, written["revenue_by_category"])
    assert cat.count() == 2
    parts = [f for f in (tmp_path / "reports" / "category_sales").iterdir() if f.name.endswith(".csv")]
    assert len(parts) == 1
    kpi = csv_ingest.read_report_csv(spark, written["kpi_summary"]).collect()
    assert [r["kpi"] for r in kpi][0] == "total_revenue"


def test_rejects_written(spark, tmp_path):
    bad = spark.createDataFrame([("a,b",), ("c",)], "_corrupt_record string")
    assert files.write_rejects(bad, str(tmp_path / "rej"))
    assert spark.read.text(str(tmp_path / "rej")).count() == 2


def test_jdbc_options_and_columns(raw_df, monkeypatch):
    monkeypatch.setenv("MYSQL_HOST", "db.example")
    conn = jdbc.connection_from_env()
    assert conn["host"] == "db.example" and conn["port"] == "3306"
    assert jdbc.mysql_url(conn).startswith("jdbc:mysql://db.example:3306/retail_sales_db")
    df = validated(raw_df, [row("T1")])
    cols = jdbc.warehouse_frame(df).columns
    assert len(cols) == 19
    opts = jdbc.jdbc_options(cols, jdbc.mysql_url(conn), "retail_sales_processed", user="u")
    assert opts["truncate"] == "true" and opts["user"] == "u" and "password" not in opts
    assert opts["createTableColumnTypes"].startswith("transaction_id VARCHAR(20), customer_id VARCHAR(20)")
    assert "order_year_month VARCHAR(7)" in opts["createTableColumnTypes"]
    assert "city" not in jdbc.jdbc_options(["transaction_id"], "u", "t")["createTableColumnTypes"]


def test_session_helpers(spark):
    from ledgerline.session import get_session, scratch_path
    assert get_session() is spark
    p = scratch_path(spark, "x")
    assert f"/ledgerline/{spark.sparkContext.applicationId}/x-" in p and p.startswith(spark.sparkContext.getCheckpointDir().rstrip("/"))


def test_cluster_session_needs_shared_checkpoint_dir():
    import pytest
    from types import SimpleNamespace
    from ledgerline.session import shared_dir

    class Ctx:
        master = "yarn"
        def getCheckpointDir(self):
            return None
        def setCheckpointDir(self, d):  # pragma: no cover - must not be reached
            raise AssertionError(d)

    fake = SimpleNamespace(sparkContext=Ctx(), conf=SimpleNamespace(get=lambda k, default=None: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake)


def test_hot_month_is_split_across_write_tasks(spark, raw_df, tmp_path):
    """One month holding every row: AQE splits the rebalance partition into
    advisory-sized pieces, so the month is written by several tasks."""
    rows = [row(f"T{i:05d}", cust=f"C{i % 97}", od="2024-05-03", dd="2024-05-09") for i in range(4000)]
    df = validated(raw_df, rows).repartition(8)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        files.write_processed(df, str(tmp_path / "processed"))
    finally:
        spark.conf.set(key, old)
    parts = [f for f in (tmp_path / "processed" / "order_year_month=2024-05").iterdir() if f.name.endswith(".parquet")]
    assert 1 < len(parts) <= 8


def test_warehouse_widths_are_counted(raw_df):
    df = validated(raw_df, [row("T1"), row("T2", qty=2000000, price="99999.555"), row("T3", price="123456789.00", total="1.00")])
    assert jdbc.too_wide(df).first().asDict() == {"unit_price": 1, "discount": 0, "total_amount": 1, "revenue": 1, "profit": 1}
    assert dict(jdbc.warehouse_frame(df).dtypes)["revenue"] == "decimal(12,2)"


def test_command_line_names_the_driver(monkeypatch):
    from ledgerline.__main__ import load_options, parse_args
    base = ["--csv", "a", "--processed", "b", "--reports", "c"]
    assert load_options(parse_args(base)) is None
    monkeypatch.setenv("LOAD_TO_MYSQL", " True ")
    opts = load_options(parse_args([*base, "--jdbc-connections", "3"]))
    assert opts["driver"] == "com.mysql.cj.jdbc.Driver" and opts["num_partitions"] == 3


class FakeWarehouse:
    """Records what a published load asks of a database; counts rows like one that loses ``lost``."""

    def __init__(self, tables=(), lost=0):
        self.tables, self.lost, self.said, self.sides = set(tables), lost, [], {}

    def exists(self, table):
        return table in self.tables

    def run(self, statements):
        self.said += statements

    def load(self, df, table, mode):
        self.sides[table] = df
        self.said.append(f"load {table} {mode}")

    def rows(self, table):
        return self.sides[table].count() - self.lost


WIDE_ROWS = [row("T1"), row("T2", qty=2000000, price="99999.555"), row("T3", cust="C" * 21), row("T4", disc="0.1")]


def test_misfits_are_split_whole(raw_df):
    fits, misfits = jdbc.split_misfits(validated(raw_df, WIDE_ROWS))
    assert sorted(r.transaction_id for r in fits.collect()) == ["T1", "T4"] and dict(fits.dtypes)["revenue"] == "decimal(12,2)"
    got = {r.transaction_id: r for r in misfits.collect()}
    assert got["T2"].misfit_columns == "total_amount,revenue,profit" and got["T2"].unit_price == "99999.555000"
    assert got["T3"].misfit_columns == "customer_id" and got["T3"].customer_id == "C" * 21
    assert misfits.columns == [*fits.columns, "misfit_columns"] and {t for _, t in misfits.dtypes} == {"string"}


def test_publish_loads_beside_and_swaps_last(raw_df):
    db = FakeWarehouse({"sales"})
    assert jdbc.publish(validated(raw_df, WIDE_ROWS), db, "sales") == (2, 2)
    assert db.said == [
        "DROP TABLE IF EXISTS `sales__load`", "CREATE TABLE `sales__load` LIKE `sales`", "load sales__load append",
        "DROP TABLE IF EXISTS `sales_misfits__load`", "load sales_misfits__load append",
        "DROP TABLE IF EXISTS `sales__before`", "RENAME TABLE `sales` TO `sales__before`, `sales__load` TO `sales`", "DROP TABLE `sales__before`",
        "RENAME TABLE `sales_misfits__load` TO `sales_misfits`"]


def test_publish_stops_before_the_swap_if_rows_are_missing(raw_df):
    import pytest
    db = FakeWarehouse({"sales"}, lost=1)
    with pytest.raises(RuntimeError, match="sales is unchanged"):
        jdbc.publish(validated(raw_df, [row("T1")]), db, "sales")
    assert not any("RENAME" in s for s in db.said)


def test_publish_without_misfits_or_target(raw_df):
    db = FakeWarehouse()
    assert jdbc.publish(validated(raw_df, [row("T1")]), db, "shop.sales") == (1, 0)
    assert db.said == ["DROP TABLE IF EXISTS `shop`.`sales__load`", "load shop.sales__load append",
                       "RENAME TABLE `shop`.`sales__load` TO `shop`.`sales`"]
    # a table of old misfits is emptied
    db = FakeWarehouse({"sales", "sales_misfits"})
    assert jdbc.publish(validated(raw_df, [row("T1")]), db, "sales") == (1, 0)
    assert "CREATE TABLE `sales_misfits__load` LIKE `sales_misfits`" in db.said and jdbc.quoted("a`b") == "`a``b`"
