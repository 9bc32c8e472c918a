"""End-to-end run: invariants between stage reports and the reports."""

from decimal import Decimal as D

from ledgerline.operators import validation
from ledgerline.plans import pipeline
from ledgerline.sources import fixture

SF = "/root/testdata/sf0.001"


def test_run_from_frame(spark, tmp_path):
    res = pipeline.run(spark, raw=fixture.sales_raw(spark, SF), processed_path=str(tmp_path / "p"),
                       reports_dir=str(tmp_path / "r"))
    s, v = res.cleaning_stats, res.validation_report
    assert s["rows_before_cleaning"] - s["total_rows_removed"] == s["rows_after_cleaning"]
    assert v["total_records_validated"] == s["rows_after_cleaning"]
    assert v["duplicate_transaction_ids_found"] == 0
    assert v == validation.validation_report(res.processed).first().asDict()   # measured on the table
    kpi = res.reports["sales_kpis"].first()
    total = kpi["total_revenue"]
    for name in ["revenue_by_category", "revenue_by_state", "monthly_revenue_trend", "customer_summary"]:
        got = sum((r["total_revenue"] for r in res.reports[name].collect()), D(0))
        assert got == total, name
    assert kpi["total_orders"] == s["rows_after_cleaning"]
    assert res.sql_reports["sql_state"].collect() == res.reports["revenue_by_state"].collect()
    assert set(res.exported) >= {"kpi_summary", "customer_summary"}


def test_run_from_csv_routes_bad_lines(spark, tmp_path):
    csv = fixture.write_sales_csv(spark, SF, str(tmp_path / "csv"))
    res = pipeline.run(spark, csv_path=csv, processed_path=str(tmp_path / "p"),
                       rejects_path=str(tmp_path / "rejects"))
    c = res.ingest_counts
    assert c["total_records"] == c["malformed_records"] + c["usable_records"]
    assert c["malformed_records"] > 0
    assert spark.read.text(str(tmp_path / "rejects")).count() == c["malformed_records"]
    assert res.cleaning_stats["rows_before_cleaning"] == c["usable_records"]


def test_run_on_empty_input(spark, tmp_path):
    from ledgerline.schema import raw_schema
    res = pipeline.run(spark, raw=spark.createDataFrame([], raw_schema()), processed_path=str(tmp_path / "p"),
                       reports_dir=str(tmp_path / "r"))
    assert res.cleaning_stats["rows_after_cleaning"] == 0
    assert res.validation_report["pct_revenue_consistent"] is None
    assert res.reports["sales_kpis"].first()["total_revenue"] is None


def test_command_line_job(spark, tmp_path, monkeypatch):
    from ledgerline.__main__ import main
    monkeypatch.delenv("LOAD_TO_MYSQL", raising=False)
    csv = fixture.write_sales_csv(spark, SF, str(tmp_path / "csv"))
    out = main(["--csv", csv, "--processed", str(tmp_path / "p"), "--reports", str(tmp_path / "r"),
                "--rejects", str(tmp_path / "rej"), "--staging", str(tmp_path / "staged")])
    assert out["ingest"]["malformed_records"] > 0
    assert out["validation"]["total_records_validated"] == out["cleaning"]["rows_after_cleaning"]
    assert out["sales_kpis"]["total_orders"] == out["cleaning"]["rows_after_cleaning"]
    assert set(out["exported"]) >= {"kpi_summary", "customer_summary"}
    assert spark.sparkContext._jsc is not None   # the caller's session is left running


def test_jdbc_load_step_gets_the_processed_table(spark, tmp_path, monkeypatch):
    from ledgerline.plans import pipeline as P
    seen = {}
    monkeypatch.setattr(P.jdbc, "write_jdbc", lambda df, **kw: seen.update(cols=df.columns, **kw))
    P.run(spark, raw=fixture.sales_raw(spark, SF), processed_path=str(tmp_path / "p"),
          jdbc_load={"url": "jdbc:mysql://db.example:3306/x", "table": "retail_sales_processed"})
    assert seen["table"] == "retail_sales_processed" and "revenue" in seen["cols"]


def test_default_staging_folder_is_removed(spark, tmp_path, monkeypatch):
    import os
    from ledgerline.plans import pipeline as P
    removed = []
    real = P.remove_path

    def spy(session, path):
        local = path.removeprefix("file:")
        removed.append((local, os.path.isdir(local)))
        return real(session, path)

    monkeypatch.setattr(P, "remove_path", spy)
    csv = fixture.write_sales_csv(spark, SF, str(tmp_path / "csv"))
    res = P.run(spark, csv_path=csv, processed_path=str(tmp_path / "p"))
    [(path, existed)] = removed
    assert "/staged-" in path and existed and not os.path.exists(path)
    assert res.processed.count() == res.cleaning_stats["rows_after_cleaning"]   # table intact
    removed.clear()
    P.run(spark, csv_path=csv, processed_path=str(tmp_path / "p2"), staging_path=str(tmp_path / "keep"))
    assert not removed and (tmp_path / "keep").is_dir()                        # named folder kept


def test_processed_table_as_csv(spark, tmp_path):
    parquet = pipeline.run(spark, raw=fixture.sales_raw(spark, SF), processed_path=str(tmp_path / "pq"))
    csv = pipeline.run(spark, raw=fixture.sales_raw(spark, SF), processed_path=str(tmp_path / "csv"),
                       processed_format="csv")
    assert csv.processed.schema == parquet.processed.schema
    assert sorted(csv.processed.collect()) == sorted(parquet.processed.collect())
    assert csv.reports["revenue_by_state"].collect() == parquet.reports["revenue_by_state"].collect()


def csv_of(tmp_path, rows):
    from ledgerline.schema import RAW_COLUMNS
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([",".join(RAW_COLUMNS), *rows]) + "\n")
    return str(tmp_path / "in")


GOOD = "T1,C1,P1,Electronics,Mumbai,S1,2,10.50,0.1000,18.90,UPI,2024-01-10,2024-01-12"


def test_malformed_lines_are_never_lost(spark, tmp_path):
    path = csv_of(tmp_path, [GOOD, "T2,bad"])
    res = pipeline.run(spark, csv_path=path, processed_path=str(tmp_path / "p"))
    assert res.rejects_path == str(tmp_path / "p") + "_rejects"
    assert [r.value for r in spark.read.text(res.rejects_path).collect()] == ["T2,bad"]
    (tmp_path / "file").write_text("not a folder")
    res = pipeline.run(spark, csv_path=path, processed_path=str(tmp_path / "p2"), rejects_path=str(tmp_path / "file" / "x"))
    from ledgerline.sources import csv_ingest
    assert [r[0] for r in csv_ingest.read_staged(spark, res.rejects_path)[1].collect()] == ["T2,bad"]


def test_csv_table_keeps_blanks_empty_and_null(spark, tmp_path):
    rows = [GOOD, GOOD.replace("T1", "T2").replace(",Electronics,", ",   ,"), GOOD.replace("T1", "T3").replace(",P1,", ", P1 ,"),
            GOOD.replace("T1", "T4").replace(",S1,", ", S1 ,"), GOOD.replace("T1", "T5").replace(",S1,", ",,"),
            GOOD.replace("T1", "T6").replace(",P1,", ',"a ""b"", \\N",')]
    path = csv_of(tmp_path, rows)
    a, b = (pipeline.run(spark, csv_path=path, processed_path=str(tmp_path / f), processed_format=f).processed
            for f in ("parquet", "csv"))
    key = lambda r: r["transaction_id"]
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)
    got = {r["transaction_id"]: r for r in b.collect()}
    assert got["T2"]["category"] == "" and got["T3"]["product_id"] == " P1 " and got["T5"]["state"] is None


def test_duplicate_ids_of_the_written_table_are_found(spark, tmp_path, monkeypatch, caplog):
    from rows import row

    from ledgerline.operators import cleaning
    from ledgerline.plans import pipeline as P
    from ledgerline.schema import raw_schema
    raw = spark.createDataFrame([row("T1"), row("T1", qty=2), row("T2")], raw_schema())
    from pyspark.sql import functions as F
    monkeypatch.setattr(P.cleaning, "deduplicate", lambda df, **kw: df.withColumns(
        {cleaning.COPIES: F.lit(1).cast("bigint"), cleaning.VARIANTS: F.lit(1).cast("bigint")}))
    res = P.run(spark, raw=raw, processed_path=str(tmp_path / "p"))
    assert res.validation_report["duplicate_transaction_ids_found"] == 1
    assert "repeat a transaction id" in caplog.text
    assert res.reports["sales_kpis"].first()["total_orders"] == 2
