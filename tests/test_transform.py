from decimal import Decimal as D

from rows import row

from ledgerline.operators import cleaning, transform


def derived(raw_df, rows, **kw):
    return transform.transform_data(cleaning.clean_data(raw_df(rows))[0], **kw)


def test_category_standardised_and_margin(raw_df):
    out = derived(raw_df, [row("T1", cat="  ELECTRONICS "), row("T2", cat="beauty & personal care"),
                           row("T3", cat="Garden"), row("T4", cat=None), row("T5", cat="   ")])
    got = {r["transaction_id"]: (r["category"], r["profit_margin"]) for r in out.collect()}
    assert got == {"T1": ("Electronics", D("0.12")), "T2": ("Beauty & Personal Care", D("0.40")),
                   "T3": ("Garden", D("0.15")), "T4": ("Uncategorized", D("0.15")), "T5": ("", D("0.15"))}


def test_city_alias_after_initcap(raw_df):
    out = derived(raw_df, [row("T1", city=" new delhi"), row("T2", city="CALCUTTA "),
                           row("T3", city="pune"), row("T4", city=None)])
    got = {r["transaction_id"]: r["city"] for r in out.collect()}
    assert got == {"T1": "Delhi", "T2": "Kolkata", "T3": "Pune", "T4": "Unknown City"}


def test_revenue_half_up_and_profit_from_rounded_revenue(raw_df):
    # 1 * 0.05 * (1 - 0.9) = 0.005 -> 0.01 (HALF_UP); 3 * 33.33 * 0.95 = 94.9905 -> 94.99
    out = derived(raw_df, [row("T1", price="0.05", disc="0.9000"), row("T2", qty=3, price="33.33", disc="0.0500")])
    got = {r["transaction_id"]: (r["revenue"], r["profit"]) for r in out.collect()}
    assert got["T1"] == (D("0.01"), D("0.00"))
    assert got["T2"] == (D("94.99"), (D("94.99") * D("0.12")).quantize(D("0.01")))


def test_date_parts(raw_df):
    r = derived(raw_df, [row("T1", od="2024-03-30", dd="2024-03-28")]).first()
    assert (r["delivery_days"], r["order_month"], r["order_year"], r["order_year_month"]) == (-2, 3, 2024, "2024-03")


def test_custom_tables(raw_df):
    out = derived(raw_df, [row("T1", cat="garden", city="poona")],
                  margins={"Garden": "0.50"}, aliases={"Poona": "Pune"})
    r = out.first()
    assert (r["category"], r["profit_margin"], r["city"]) == ("Garden", D("0.50"), "Pune")
    r = derived(raw_df, [row("T1", cat="Kid's toys", city="bombay")],
                margins={"Kid's Toys": "0.33"}, aliases={}).first()
    assert (r["category"], r["profit_margin"], r["city"]) == ("Kid's Toys", D("0.33"), "Bombay")


def test_clean_transform_idempotent_on_text(raw_df):
    once = derived(raw_df, [row("T1", cat="  toys & games", city="Bombay")])
    cols = [c for c in once.columns if c in {"category", "city"}]
    again = transform.transform_data(once.select(*[c for c in once.columns if c not in
                                                   {"revenue", "profit_margin", "profit", "delivery_days",
                                                    "order_month", "order_year", "order_year_month"}]))
    assert once.select(cols).collect() == again.select(cols).collect()


def test_numeric_parse_and_label(spark):
    df = spark.createDataFrame([("3", "A", "S"), ("#REF!", "B", "T"), ("", "C", "U")], "q string, city string, state string")
    out = transform.city_labels(transform.parse_numeric(df, {"q": "int"})).collect()
    assert [r["q"] for r in out] == [3, None, None]
    assert out[0]["city_label"] == "A (S)"
