from decimal import Decimal as D

from rows import row

from ledgerline.operators import cleaning, reports, transform, validation
from ledgerline.plans import sql_reports


def validated(raw_df, rows):
    return validation.add_flags(transform.transform_data(cleaning.clean_data(raw_df(rows))[0]))


def test_exact_average_rounds_once(spark):
    # mean = 0.0049999... in a 16,6 decimal average would round to 0.005000 then 0.01
    vals = [D("0.01")] * 4999 + [D("0.00")] * 5001
    df = spark.createDataFrame([(v,) for v in vals], "revenue decimal(12,2)")
    got = df.agg(reports.avg_half_up("revenue").alias("a")).first()["a"]
    assert got == D("0.00")
    vals = [D("0.01")] * 5000 + [D("0.00")] * 5000
    df = spark.createDataFrame([(v,) for v in vals], "revenue decimal(12,2)")
    assert df.agg(reports.avg_half_up("revenue").alias("a")).first()["a"] == D("0.01")


def test_kpis_guest_counts_once_and_delivery_excludes_null_flags(raw_df):
    df = validated(raw_df, [
        row("T1", cust=None, dd="2024-01-14"), row("T2", cust=None, dd="2024-01-09"),
        row("T3", cust="C1", dd=None), row("T4", cust="C1", qty=3, dd="2024-01-11"),
    ])
    k = reports.sales_kpis(df, with_delivery=True).first().asDict()
    assert k["total_customers"] == 2 and k["total_orders"] == 4
    assert k["total_revenue"] == D("60.00") and k["average_order_value"] == D("15.00")
    assert k["average_delivery_days"] == D("2.50")  # (4 + 1) / 2; T2 violates, T3 NULL
    assert reports.average_delivery_time(df).first()[0] == D("2.50")


def test_top_k_ties_broken_by_keys(raw_df):
    df = validated(raw_df, [row(f"T{i}", prod=f"P{i % 3}") for i in range(9)])
    out = reports.top_products(df, 2).collect()
    assert [r["product_id"] for r in out] == ["P0", "P1"]


def test_unique_ids_shortcut_equals_distinct(raw_df):
    df = validated(raw_df, [row(f"T{i}", cat=["a", "b"][i % 2]) for i in range(10)])
    a = reports.revenue_by_category(df, unique_ids=True).collect()
    b = reports.revenue_by_category(df, unique_ids=False).collect()
    assert a == b


def test_customer_summary_and_sql_top_customers(spark, raw_df):
    df = validated(raw_df, [row("T1", cust=None, qty=100), row("T2", cust="C1", qty=2, od="2024-02-01"),
                            row("T3", cust="C1", qty=1), row("T4", cust="C2")])
    cs = {r["customer_id"]: r for r in reports.customer_summary(df).collect()}
    assert cs["C1"]["total_orders"] == 2 and cs["C1"]["avg_order_value"] == D("15.00")
    assert str(cs["C1"]["last_order_date"]) == "2024-02-01"
    top = sql_reports.run_sql(spark, "sql_top_customers", df).collect()
    assert [r["customer_id"] for r in top] == ["C1", "C2"]


def test_kpi_long_shape(raw_df):
    df = validated(raw_df, [row("T1")])
    out = reports.kpi_long(reports.sales_kpis(df, with_delivery=True)).collect()
    assert [r["kpi"] for r in out] == ["total_revenue", "total_orders", "average_order_value",
                                       "total_customers", "average_delivery_days"]


def test_sql_delivery_ignores_negative(spark, raw_df):
    df = validated(raw_df, [row("T1", dd="2024-01-15"), row("T2", dd="2024-01-01")])
    r = sql_reports.run_sql(spark, "sql_delivery", df).first().asDict()
    assert r == {"avg_delivery_days": D("5.00"), "min_delivery_days": 5, "max_delivery_days": 5}


def test_orders_are_distinct_ids_by_default(spark, raw_df):
    clean = validation.add_flags(transform.transform_data(cleaning.parse_dates(
        cleaning.impute_defaults(raw_df([row("T1"), row("T1", qty=2)])))))
    frames = [reports.sales_kpis(clean), reports.revenue_by_category(clean), reports.revenue_by_state(clean),
              reports.monthly_revenue_trend(clean), reports.customer_summary(clean),
              *[sql_reports.run_sql(spark, n, clean) for n in ("sql_monthly", "sql_best_category", "sql_top_customers", "sql_state")]]
    assert [f.first()["total_orders"] for f in frames] == [1] * 9


def test_reports_are_sorted(spark):
    from ledgerline.plans import catalog
    sf = "/root/testdata/sf0.001"
    for name, key in (("revenue_by_category", "category"), ("revenue_by_state", "state"), ("customer_summary", "customer_id"),
                      ("top_products", "product_id"), ("top_cities", "city"), ("sql_category_rank", "category"),
                      ("sql_state", "state"), ("sql_top_customers", "customer_id")):
        rows = [(-r["total_revenue"], r[key]) for r in catalog.QUERIES[name](spark, sf).collect()]
        assert rows == sorted(rows), name
    for name in ("monthly_trend", "sql_monthly"):
        rows = [(r["order_year"], r["order_month"]) for r in catalog.QUERIES[name](spark, sf).collect()]
        assert rows == sorted(rows), name


def test_one_absurd_row_does_not_end_the_run(raw_df):
    df = validated(raw_df, [row("T1", qty=2 ** 31 - 1, price="999999999.999999", disc="-999.000000", total="0.00"), row("T2")])
    k = reports.sales_kpis(df, with_delivery=True).first()
    assert k["average_order_value"] == (k["total_revenue"] / 2).quantize(D("0.01"))
