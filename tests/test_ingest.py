from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerline.schema import RAW_COLUMNS
from ledgerline.sources import csv_ingest

HEADER = ",".join(RAW_COLUMNS)
GOOD = "T1,C1,P1,Electronics,Mumbai,S1,2,10.50,0.1000,18.90,UPI,2024-01-10,2024-01-12"
LINES = [
    HEADER,
    GOOD,
    "T2,C1,P1,Electronics,Mumbai,S1,#REF!,10.50,0.1000,18.90,UPI,2024-01-10,2024-01-12",   # bad int
    "T3,C1,P1,Electronics,Mumbai,S1,2,N/A,0.1000,18.90,UPI,2024-01-10,2024-01-12",         # bad decimal
    "T4,C1,P1,Electronics,Mumbai,S1,2,10.50,0.1000,18.90,UPI,2024-01-10",                  # too few
    "T5,C1,P1,Electronics,Mumbai,S1,2,10.50,0.1000,18.90,UPI,2024-01-10,2024-01-12,X",     # too many
    "T6,C1,P1,Electronics,Mumbai,S1,,10.50,0.1000,18.90,UPI,2024-01-10,2024-01-12",        # blank qty: ok
    "T7,C1,P1,   ,Mumbai,S1,2,10.50,0.1000,18.90,UPI,2024-01-10,2024-01-12",               # spaces: ok
    'T8,C1,P1,Electronics,"Navi Mumbai, Thane",S1,2,10.50,0.1000,18.90,UPI,2024-1-5,2024-01-12',  # quoted comma
    "",
]


def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES[1:]], "value string")


def test_routing(spark):
    ing = csv_ingest.ingest_lines(lines(spark))
    assert sorted(r["transaction_id"] for r in ing.good.collect()) == ["T1", "T6", "T7", "T8"]
    assert ing.bad.count() == 4
    assert ing.counts.first().asDict() == {"total_records": 8, "malformed_records": 4, "usable_records": 4}


def test_routing_independent_of_projection(spark):
    ing = csv_ingest.ingest_lines(lines(spark))
    assert ing.good.count() == 4
    assert ing.good.select("transaction_id", "state").count() == 4
    assert ing.good.select("state").distinct().count() == 1
    assert ing.bad.select(F.length("_corrupt_record")).count() == 4


def test_values_kept_as_text(spark):
    good = {r["transaction_id"]: r for r in csv_ingest.ingest_lines(lines(spark)).good.collect()}
    assert good["T7"]["category"] == "   "
    assert good["T6"]["quantity"] is None
    assert good["T8"]["city"] == "Navi Mumbai, Thane" and good["T8"]["order_date"] == "2024-1-5"
    assert good["T1"]["unit_price"] == D("10.50") and good["T1"]["discount"] == D("0.1000")


def test_csv_files_and_preview(spark, tmp_path):
    p = str(tmp_path / "in")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(p)
    ing = csv_ingest.ingest_csv(spark, p)
    assert ing.good.count() == 4
    prev = {r["column"]: r["inferred_type"] for r in csv_ingest.infer_schema_preview(spark, p, 1.0).collect()}
    assert list(prev) == RAW_COLUMNS
    assert prev["quantity"] == "string"  # garbage tokens make the column text


def test_staged_ingest_counts_in_result_stage(spark, tmp_path):
    from pyspark.sql import Observation
    parsed = csv_ingest.parse_lines(lines(spark))
    assert "Exchange" not in parsed._jdf.queryExecution().executedPlan().toString()  # no map stage
    obs = Observation("staged")
    path = csv_ingest.write_staged(parsed, str(tmp_path / "staged"), obs)
    assert obs.get == {"total_records": 8, "malformed_records": 4, "usable_records": 4}
    good, bad = csv_ingest.read_staged(spark, path)
    assert good.columns == RAW_COLUMNS
    assert sorted(r["transaction_id"] for r in good.collect()) == ["T1", "T6", "T7", "T8"]
    assert bad.count() == 4
    good_scan = [x for x in good._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x][0]
    assert "PartitionFilters: [isnotnull(_malformed" in good_scan   # reads only its own folder


def test_first_line_of_a_file_is_its_header(spark, tmp_path):
    quoted = ",".join(f'"{c.upper()}"' for c in RAW_COLUMNS)
    spaced = ", ".join(RAW_COLUMNS)
    for name, head in (("a", HEADER), ("b", quoted), ("c", spaced)):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.csv").write_text("\n".join([head, GOOD, HEADER, GOOD + "\x01x"]) + "\n")
    ing = csv_ingest.ingest_csv(spark, str(tmp_path / "in"))
    # a header further down is a line like any other, and no line is cut
    assert ing.counts.first().asDict() == {"total_records": 9, "malformed_records": 3, "usable_records": 6}
    assert sorted({r["delivery_date"] for r in ing.good.collect()}) == ["2024-01-12", "2024-01-12\x01x"]


def test_wide_numbers_are_neither_rejected_nor_rounded(spark):
    text = [GOOD.replace(",2,10.50,0.1000,18.90,", f",{q},{p},{d},{t},") for q, p, d, t in (
        (1, "10.555", "0.12345", "9.25"), (1, "123456789.00", "0", "12345678901.00"), (1, "5", "10", "-45"),
        (2000000, "99999", "0", "199998000000"))]
    good = csv_ingest.ingest_lines(spark.createDataFrame([(x,) for x in text], "value string")).good
    got = [(r["unit_price"], r["discount"], r["total_amount"]) for r in good.collect()]
    assert got == [(D("10.555"), D("0.12345"), D("9.25")), (D("123456789"), D("0"), D("12345678901")),
                   (D("5"), D("10"), D("-45")), (D("99999"), D("0"), D("199998000000"))]
    from ledgerline.operators import transform
    from ledgerline.operators.cleaning import parse_dates
    money = transform.transform_data(parse_dates(good), margins={"Electronics": "0.125"}).collect()
    assert [r["revenue"] for r in money] == [D("9.25"), D("123456789.00"), D("-45.00"), D("199998000000.00")]
    assert [r["profit"] for r in money] == [D("1.16"), D("15432098.63"), D("-5.63"), D("24999750000.00")]


def test_preview_of_many_files(spark, tmp_path):
    from ledgerline.sources import fixture
    path = fixture.write_sales_csv(spark, "/root/testdata/sf0.001", str(tmp_path / "csv"))
    prev = csv_ingest.infer_schema_preview(spark, path)
    assert [r["column"] for r in prev.collect()] == RAW_COLUMNS


def test_long_keys_stay_whole(spark):
    from ledgerline.sources.fixture import padded
    got = spark.sql(f"SELECT {padded('k', 9)} AS v FROM VALUES (10000000000), (15000001), (7) AS t(k)").collect()
    assert [r.v for r in got] == ["10000000000", "015000001", "000000007"]


REASONED = {
    "T2,C1,P1,E,M,S1,#REF!,10.50,0.1,18.90,UPI,2024-01-10,2024-01-12": ["not_a_number:quantity"],
    "T3,C1,P1,E,M,S1,2,N/A,x,18.90,UPI,2024-01-10,2024-01-12": ["not_a_number:unit_price", "not_a_number:discount"],
    "T4,C1,P1,E,M,S1,2,10.50,0.1,18.90,UPI,2024-01-10": ["too_few_fields"],
    "T5,C1,P1,E,M,S1,2,10.50,0.1,18.90,UPI,2024-01-10,2024-01-12,": ["too_many_fields"],
    "T6,C1,P1,E,M,S1,2.0,10.50,0.1,18.90,UPI,2024-01-10,2024-01-12": ["not_an_integer:quantity"],
    "T7,C1,P1,E,M,S1,2147483648,10.50,0.1,18.90,UPI,2024-01-10,": ["too_wide:quantity"],
    "T8,C1,P1,E,M,S1,2,1234567890.5,1000,1e30,UPI,2024-01-10,": ["too_wide:unit_price", "too_wide:discount", "too_wide:total_amount"],
    "T9": ["too_few_fields"],
    'T10,C1,P1,E,"M, N",S1, 2,10.50,0.1,18.90,UPI,2024-01-10,2024-01-12': ["not_a_number:quantity"],
    'T11,C1,P1,E,"M,S1,2,10.50,0.1,18.90,UPI,2024-01-10,2024-01-12,x,y': ["unreadable"],
    "T12,C1,P1,E,M,S1,2,10.50,0.1,18.90,UPI,2024-01-10,,": ["too_many_fields"],
}


def test_reasons_of_rejects(spark):
    text = spark.createDataFrame([(x,) for x in [*REASONED, GOOD, GOOD.replace(",2,10.50", ',,"1,050.25"')]], "value string")
    ing = csv_ingest.ingest_lines(text)
    assert {r["_corrupt_record"]: r["_reasons"] for r in ing.bad.collect()} == REASONED
    assert sorted(r["unit_price"] for r in ing.good.collect()) == [D("10.5"), D("1050.25")]
    assert csv_ingest.ingest_counts(csv_ingest.parse_lines(text), by_reason=True).first().asDict() == {
        "total_records": 13, "malformed_records": 11, "usable_records": 2, "too_few_fields_records": 2, "too_many_fields_records": 2,
        "not_a_number_records": 3, "not_an_integer_records": 1, "too_wide_records": 2, "unreadable_records": 1}


def test_rejects_by_reason(spark, tmp_path):
    from ledgerline.sinks import files
    bad = csv_ingest.ingest_lines(spark.createDataFrame([(x,) for x in REASONED], "value string")).bad
    assert files.write_rejects(bad, str(tmp_path / "rej"))
    got = {r.value: r.reason for r in files.read_rejects(spark, str(tmp_path / "rej")).collect()}
    assert got == {line: codes[0].partition(":")[0] for line, codes in REASONED.items()}
    assert files.write_rejects(bad.filter("false"), str(tmp_path / "none"))
    assert files.read_rejects(spark, str(tmp_path / "none")).count() == 0


def test_a_line_is_parsed_and_rendered_once(spark):
    from ledgerline.sources import fixture
    good = csv_ingest.ingest_lines(fixture.sales_csv_lines(spark, "/root/testdata/sf0.001")).good
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv") == 1 and plan.count("concat_ws") == 1 and plan.count("regexp_replace") == 1


def typed(spark, columns):
    n = max(map(len, columns.values()))
    rows = [[v[i] if i < len(v) else None for v in columns.values()] for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)).repartition(3)
    return {r["column"]: r["inferred_type"] for r in csv_ingest.infer_types(df).collect()}


def test_types_are_the_join_of_all_values(spark):
    assert typed(spark, {
        "none": [], "int": ["1", "-2147483648", "+7", "007"], "bigint": ["1", "2147483648"], "past": ["9223372036854775808"],
        "decimal": ["1", "12.5", ".125", "3."], "zero": ["0.0", "-0"], "sum": ["1234567890123456789012345678901234567", "0.5"],
        "wide": ["12345678901234567890123456789012345678", "0.5"], "exp": ["1", "2.5e3"], "date": ["2024-01-10", "2023-12-31"],
        "no date": ["2024-01-10", "2024-13-01"], "mixed": ["2024-01-10", "5"], "text": ["1", "x"], "blank": ["1", " "], "nan": ["1.5", "NaN"],
    }) == {"none": "null", "int": "int", "bigint": "bigint", "past": "decimal(19,0)", "decimal": "decimal(5,3)", "zero": "decimal(1,1)",
           "sum": "decimal(38,1)", "wide": "double", "exp": "double", "date": "date", "no date": "string", "mixed": "string",
           "text": "string", "blank": "string", "nan": "string"}


def test_types_see_the_last_line(spark, tmp_path):
    from ledgerline.schema import RAW_COLUMNS as names
    good = ["1"] * len(names)
    (tmp_path / "a.csv").write_text("\n".join([",".join(names), *[",".join(good)] * 5000, ",".join(["x", *good[1:]])]) + "\n")
    found = csv_ingest.infer_csv_types(spark, str(tmp_path / "a.csv")).collect()
    assert {r["column"]: (r["inferred_type"], r["n_int"], r["n_string"]) for r in found} == {
        c: ("string", 5000, 1) if c == names[0] else ("int", 5001, 0) for c in names}
