"""Property tests: key dedup and the cleaning statistics against a brute-force
model in plain Python, over random rows with many duplicate and NULL keys,
in any row order and any number of input partitions."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from rows import row

from ledgerline.operators import cleaning
from ledgerline.schema import raw_schema

ONE_ROW = st.builds(
    lambda tid, cust, qty, pay, od: row(tid, cust=cust, qty=qty, pay=pay, od=od),
    st.sampled_from(["T1", "T2", "T3", None]),
    st.sampled_from(["C1", "C2", None]),
    st.sampled_from([-3, 1, 2, None]),
    st.sampled_from(["UPI", None]),
    st.sampled_from(["2024-01-10", "2024-13-45", None]),
)
VALID_DATES = {"2024-01-10"}


def nulls_first(values):
    return tuple((v is not None, v) for v in values)


def model(rows):
    distinct = set(rows)
    groups = {}
    for r in distinct:
        groups.setdefault(r[0], []).append(r)
    survivors = {k: min(v, key=lambda r: nulls_first(r[1:])) for k, v in groups.items()}
    kept = list(survivors.values())
    bad_dates = sum(r[11] not in VALID_DATES for r in kept)
    stats = {
        "rows_before_cleaning": len(rows),
        "exact_duplicate_rows_removed": len(rows) - len(distinct),
        "duplicate_transaction_ids_removed": len(distinct) - len(groups),
        "missing_customer_id_imputed": sum(r[1] is None for r in kept),
        "missing_payment_method_imputed": sum(r[10] is None for r in kept),
        "missing_category_imputed": 0,
        "missing_city_imputed": 0,
        "negative_quantities_corrected": sum(r[6] is not None and r[6] < 0 for r in kept),
        "invalid_order_dates_dropped": bad_dates,
        "rows_after_cleaning": len(kept) - bad_dates,
        "total_rows_removed": len(rows) - len(kept) + bad_dates,
    }
    return survivors, stats


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(rows=st.lists(ONE_ROW, max_size=30), seed=st.integers(0, 10**6), parts=st.integers(1, 5))
def test_dedup_and_stats_match_model(spark, rows, seed, parts):
    shuffled = list(rows)
    random.Random(seed).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, raw_schema()).repartition(parts)
    want_survivors, want_stats = model(rows)

    deduped = cleaning.deduplicate(df, keep_counts=True)
    got = {r[0]: tuple(r[:13]) for r in cleaning.deduplicate(df).collect()}
    assert got == want_survivors
    assert cleaning.cleaning_stats(deduped).first().asDict() == want_stats
