from decimal import Decimal as D

from rows import row

from ledgerline.operators import cleaning, transform, validation


def validated(raw_df, rows):
    return validation.validate_data(transform.transform_data(cleaning.clean_data(raw_df(rows))[0]))


def test_flags_and_null_semantics(raw_df):
    df, rep = validated(raw_df, [
        row("T1"),                                  # consistent, ok
        row("T2", total="5.00"),                    # inconsistent
        row("T3", qty=2, total="20.99"),            # |20.99 - 20| < 1 -> consistent
        row("T4", qty=2, total="21.00"),            # difference exactly 1 -> inconsistent
        row("T5", dd="2024-01-01"),                 # delivery before order
        row("T6", dd=None),                         # NULL flag: not a violation
    ])
    flags = {r["transaction_id"]: (r["revenue_consistent"], r["date_integrity_ok"]) for r in df.collect()}
    assert flags["T3"][0] is True and flags["T4"][0] is False
    assert flags["T6"][1] is None
    r = rep.first().asDict()
    assert r == {"total_records_validated": 6, "duplicate_transaction_ids_found": 0,
                 "revenue_inconsistent_records": 2, "pct_revenue_consistent": D("66.67"),
                 "date_integrity_violations": 1, "pct_date_integrity_ok": D("83.33")}


def test_report_empty_frame_gives_null_pct(raw_df):
    r = validated(raw_df, [])[1].first().asDict()
    assert r["total_records_validated"] == 0 and r["pct_revenue_consistent"] is None


def test_uniqueness_counts_null_as_one_value(raw_df):
    df = raw_df([row(None), row(None, cust="X"), row("T1"), row("T1", cust="Y")])
    r = validation.uniqueness_check(df).first().asDict()
    assert r == {"total_records": 4, "distinct_ids": 2, "duplicate_ids": 2}


def test_quality_profile_counts_all_members(raw_df):
    df = raw_df([row("T1"), row("T1"), row("T1", cust=None), row("T2", qty=-1), row("T3", cat=None, city=None, pay=None)])
    r = validation.quality_profile(df).first().asDict()
    assert r == {"missing_customer_id": 1, "missing_payment_method": 1, "missing_category": 1,
                 "missing_city": 1, "negative_quantity": 1, "duplicate_rows_exact": 2,
                 "duplicate_transaction_ids": 3}
