from decimal import Decimal as D

from rows import row

from ledgerline.operators import cleaning
from ledgerline.schema import raw_schema


def stats_of(df):
    return cleaning.clean_data(df)[1].first().asDict()


def test_exact_duplicates_dropped(raw_df):
    df = raw_df([row("T1"), row("T1"), row("T2")])
    assert cleaning.drop_exact_duplicates(df).count() == 2


def test_key_dedup_survivor_is_least_row_nulls_first(raw_df):
    df = raw_df([row("T1", cust="CUST9"), row("T1", cust=None), row("T1", cust="CUST1")])
    out = cleaning.deduplicate(df).collect()
    assert len(out) == 1 and out[0]["customer_id"] is None


def test_key_dedup_tie_breaks_on_later_columns(raw_df):
    df = raw_df([row("T1", qty=5), row("T1", qty=2), row("T1", qty=None)])
    assert cleaning.deduplicate(df).first()["quantity"] is None


def test_null_key_is_one_group(raw_df):
    df = raw_df([row(None, cust="B"), row(None, cust="A"), row("T1")])
    out = {r["transaction_id"]: r["customer_id"] for r in cleaning.deduplicate(df).collect()}
    assert out == {None: "A", "T1": "CUST1"}


def test_stats_counting_points(raw_df):
    df = raw_df([
        row("T1"), row("T1"),                       # exact duplicate
        row("T2", cust=None), row("T2", cust="X"),  # key duplicate; survivor has NULL customer
        row("T3", qty=-4, pay=None),
        row("T4", cat=None, city=None, od="2024-13-45"),  # counted as missing, then dropped
        row("T5", od=""),
    ])
    s = stats_of(df)
    assert s["rows_before_cleaning"] == 7
    assert s["exact_duplicate_rows_removed"] == 1
    assert s["duplicate_transaction_ids_removed"] == 1
    assert s["missing_customer_id_imputed"] == 1
    assert s["missing_payment_method_imputed"] == 1
    assert s["missing_category_imputed"] == 1
    assert s["missing_city_imputed"] == 1
    assert s["negative_quantities_corrected"] == 1
    assert s["invalid_order_dates_dropped"] == 2
    assert s["rows_after_cleaning"] == 3
    assert s["total_rows_removed"] == s["rows_before_cleaning"] - s["rows_after_cleaning"]


def test_imputation_is_null_only(raw_df):
    df = raw_df([row("T1", cat="   ", city=None, cust=None, pay=None)])
    r = cleaning.clean_data(df)[0].first()
    assert r["category"] == "   "
    assert (r["city"], r["customer_id"], r["payment_method"]) == ("Unknown City", "GUEST_CUSTOMER", "Not Specified")


def test_abs_quantity_and_int_min(raw_df):
    df = raw_df([row("T1", qty=-3), row("T2", qty=None, total="1.00"), row("T3", qty=-2147483648, total="1.00")])
    got = {r["transaction_id"]: r["quantity"] for r in cleaning.correct_quantity(df).collect()}
    assert got == {"T1": 3, "T2": None, "T3": None}


def test_bad_dates_null_and_bad_delivery_kept(raw_df):
    df = raw_df([
        row("T1", od="31-02-2024"), row("T2", od="NaT"), row("T3", od="2025/02/30"),
        row("T4", od="0000-00-00"), row("T5", od=None),
        row("T6", dd="2024-13-45"), row("T7", od="2024-1-5"), row("T8", od=" 2024-01-05"),
    ])
    out = {r["transaction_id"]: r["delivery_date"] for r in cleaning.clean_data(df)[0].collect()}
    assert out == {"T6": None}


def test_dates_become_date_type_and_last(raw_df):
    df = cleaning.clean_data(raw_df([row("T1")]))[0]
    assert df.columns[-2:] == ["order_date", "delivery_date"]
    assert df.schema["order_date"].dataType.simpleString() == "date"
    assert df.first()["unit_price"] == D("10.00")


def test_empty_frame_stats(raw_df):
    s = stats_of(raw_df([]))
    assert s["rows_before_cleaning"] == 0 and s["rows_after_cleaning"] == 0


def test_one_shuffle_dedup_equals_two(spark, raw_df):
    """Also with frequent ids and rows without one; whole rows of other ids are shuffled once."""
    import random
    rng = random.Random(4)
    rows = [row(rng.choice([None, "HOT", *[f"T{k}" for k in range(300)]]) if k % 2 else rng.choice([None, "HOT"]),
                cust=f"C{rng.randint(1, 3)}", qty=rng.randint(1, 3)) for k in range(2500)]
    df = raw_df(rows).repartition(6)
    frequent = cleaning.frequent_keys(df, share=0.05)
    assert "HOT" in frequent and len(frequent) <= 30
    for keep in (False, True):
        want = cleaning.deduplicate(df, keep_counts=keep)
        for keys in (frequent, [], ["HOT"]):
            got = cleaning.deduplicate_once(df, keys, keep_counts=keep)
            assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    plan = cleaning.deduplicate_once(df, [], keep_counts=True)._jdf.queryExecution().executedPlan().toString()
    cold = plan.split("Union")[1].split("REPARTITION_BY_COL")[0]
    assert "hashpartitioning(transaction_id" in plan and cold.count("Exchange hashpartitioning") == 1


def test_deduplicate_of_a_written_table_shuffles_repeated_ids_only(spark, tmp_path, monkeypatch):
    """Same rows as ``deduplicate``, with null and hot ids, also where the bitmap is too small to tell ids apart."""
    made = [row(f"T{i % 90}" if i % 3 else None, qty=i % 4) for i in range(400)] + [row(f"U{i}") for i in range(300)]
    spark.createDataFrame(made, raw_schema()).write.parquet(str(tmp_path / "t"))
    df = spark.read.schema(raw_schema()).parquet(str(tmp_path / "t"))
    for most in (cleaning.MOST_BITS, 32):
        monkeypatch.setattr(cleaning, "MOST_BITS", most)
        for keep in (False, True):
            got, want = (f(df, keep_counts=keep) for f in (cleaning.deduplicate_written, cleaning.deduplicate))
            assert got.columns == want.columns and got.dtypes == want.dtypes
            assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
        dealt = cleaning.repeated_bitmap(df)[1]
        assert dealt == (32 if most == 32 else 32768)
    empty = cleaning.deduplicate_written(spark.createDataFrame([], raw_schema()), keep_counts=True)
    assert empty.count() == 0
