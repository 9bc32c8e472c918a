"""SQL twin (DuckDB dialect) of every query in ``ledgerline.plans.catalog``."""

from __future__ import annotations

from ledgerline.checks.oracle_sql import BASE, CLEAN, DEDUP, TRANSFORM, VALIDATE, amount, avg2, initcap, money, pct2, with_stage
from ledgerline.checks.oracle_sql import _city_alias  # noqa: PLC2701 - shared CASE text
from ledgerline.checks.oracle_sql import _key as padded_key  # noqa: PLC2701 - shared key text
from ledgerline.functions.columns import DEFAULT_MARGIN
from ledgerline.schema import RAW_COLUMNS
from ledgerline.sinks.jdbc import WAREHOUSE_TEXT_WIDTHS
from ledgerline.sources import fixture as fx

_raw13 = ", ".join(RAW_COLUMNS)
_tokens = "[" + ", ".join(f"'{t}'" for t in fx.GARBAGE_TOKENS) + "]"

# The CSV rendering of each raw row, with the CSV-only faults of FIXTURES.md section 5.
CSV = f"""
, csv_src AS (
  SELECT *, {_tokens}[(l_linenumber % {len(fx.GARBAGE_TOKENS)}) + 1] AS token,
    l_orderkey % {fx.CSV_SHORT} = 0 AS too_few,
    l_orderkey % {fx.CSV_SHORT} <> 0 AND l_orderkey % {fx.CSV_LONG} = 0 AS too_many,
    l_orderkey % {fx.CSV_SHORT} <> 0 AND l_orderkey % {fx.CSV_LONG} <> 0 AS fields_ok,
    fields_ok AND (l_orderkey % {fx.CSV_QTY_TOKEN} = 0 OR l_orderkey % {fx.CSV_PRICE_TOKEN} = 0) AS not_a_number,
    fields_ok AND l_orderkey % {fx.CSV_QTY_TOKEN} <> 0 AND l_orderkey % {fx.CSV_BLANK_QTY} <> 0
      AND l_orderkey % {fx.CSV_DECIMAL_QTY} = 0 AS not_an_integer,
    fields_ok AND l_orderkey % {fx.CSV_PRICE_TOKEN} <> 0 AND l_orderkey % {fx.CSV_WIDE_PRICE} = 0 AS too_wide,
    too_few OR too_many OR not_a_number OR not_an_integer OR too_wide AS malformed
  FROM fx_keyed
),
csv_fields AS (
  SELECT l_orderkey, malformed, too_few, too_many, not_a_number, not_an_integer, too_wide,
    coalesce(transaction_id, '') AS f_transaction_id,
    coalesce(customer_id, '') AS f_customer_id,
    coalesce(product_id, '') AS f_product_id,
    CASE WHEN l_orderkey % {fx.CSV_SPACES_CATEGORY} = 0 THEN '{fx.SPACES_CATEGORY}' ELSE coalesce(category, '') END AS f_category,
    CASE WHEN l_orderkey % {fx.CSV_QUOTED_CITY} = 0 THEN '{fx.QUOTED_CITY}' ELSE coalesce(city, '') END AS f_city,
    coalesce(state, '') AS f_state,
    CASE WHEN l_orderkey % {fx.CSV_QTY_TOKEN} = 0 THEN token WHEN l_orderkey % {fx.CSV_BLANK_QTY} = 0 THEN ''
         WHEN l_orderkey % {fx.CSV_DECIMAL_QTY} = 0 THEN '{fx.DECIMAL_QTY}' ELSE coalesce(CAST(quantity AS VARCHAR), '') END AS f_quantity,
    CASE WHEN l_orderkey % {fx.CSV_PRICE_TOKEN} = 0 THEN token WHEN l_orderkey % {fx.CSV_WIDE_PRICE} = 0 THEN '{fx.WIDE_PRICE}'
         ELSE coalesce(CAST(unit_price AS VARCHAR), '') END AS f_unit_price,
    coalesce(CAST(discount AS VARCHAR), '') AS f_discount,
    coalesce(CAST(total_amount AS VARCHAR), '') AS f_total_amount,
    coalesce(payment_method, '') AS f_payment_method,
    coalesce(order_date, '') AS f_order_date,
    coalesce(delivery_date, '') AS f_delivery_date
  FROM csv_src
),
csv_lines AS (
  SELECT l_orderkey, malformed, too_few, too_many, not_a_number, not_an_integer, too_wide,
    f_transaction_id, f_quantity, f_unit_price,
    concat_ws(',', f_transaction_id, f_customer_id, f_product_id,
      f_category,
      CASE WHEN l_orderkey % {fx.CSV_QUOTED_CITY} = 0 THEN '"' || f_city || '"' ELSE f_city END,
      f_state, f_quantity, f_unit_price, f_discount, f_total_amount, f_payment_method,
      f_order_date, f_delivery_date) AS line0
  FROM csv_fields
),
csv_final AS (
  SELECT *,
    CASE WHEN l_orderkey % {fx.CSV_SHORT} = 0 THEN regexp_replace(line0, ',[^,]*$', '')
         WHEN l_orderkey % {fx.CSV_LONG} = 0 THEN line0 || ',EXTRA'
         ELSE line0 END AS line
  FROM csv_lines
)"""


def _csv(body: str) -> str:
    return with_stage("sales_raw", CSV + "\n" + body)


_good_rows = f"""
SELECT nullif(f_transaction_id, '') AS transaction_id, nullif(f_customer_id, '') AS customer_id,
  nullif(f_product_id, '') AS product_id, nullif(f_category, '') AS category, nullif(f_city, '') AS city,
  nullif(f_state, '') AS state, CAST(nullif(f_quantity, '') AS INTEGER) AS quantity,
  CAST(nullif(f_unit_price, '') AS DECIMAL(15,6)) AS unit_price,
  CAST(nullif(f_discount, '') AS DECIMAL(9,6)) AS discount,
  CAST(nullif(f_total_amount, '') AS DECIMAL(24,6)) AS total_amount,
  nullif(f_payment_method, '') AS payment_method, nullif(f_order_date, '') AS order_date,
  nullif(f_delivery_date, '') AS delivery_date
FROM csv_fields WHERE NOT malformed"""

# The whole run from CSV text: the usable lines take the raw view's place.
_CSV_RUN = ("WITH " + BASE + CSV + ", sales_raw AS (" + _good_rows + "), "
            + ", ".join([DEDUP, CLEAN, TRANSFORM, VALIDATE]))
_big = "CAST({} AS BIGINT)"


def _b(x: str) -> str:
    return _big.format(x)


_orders = _b("count(DISTINCT transaction_id)")

_cat_report = f"""
SELECT category, {money('revenue')} AS total_revenue, {money('profit')} AS total_profit,
  {_orders} AS total_orders
FROM validated GROUP BY category"""

_kpi_cols = ["total_revenue", "total_orders", "average_order_value", "total_customers",
             "average_delivery_days"]

_kinds = [(k, k.removesuffix("_fields")) for k in ("too_few_fields", "too_many_fields", "not_a_number", "not_an_integer", "too_wide")]
_INGEST = ", ".join([_b("count(*)") + " AS total_records", _b("count(*) FILTER (malformed)") + " AS malformed_records",
                     _b("count(*) FILTER (NOT malformed)") + " AS usable_records",
                     *[_b(f"count(*) FILTER ({flag})") + f" AS {kind}_records" for kind, flag in _kinds],
                     "CAST(0 AS BIGINT) AS unreadable_records"])

# Every field of the CSV text, its class, and the join of the classes.
_TYPES = (", field_values AS (SELECT unnest([" + ", ".join(f"'{c}'" for c in RAW_COLUMNS) + "]) AS column_name, unnest(["
          + ", ".join("CASE WHEN too_few THEN NULL ELSE nullif(f_delivery_date, '') END" if c == "delivery_date"
                      else f"nullif(f_{c}, '')" for c in RAW_COLUMNS) + """]) AS v FROM csv_fields),
classed AS (
  SELECT column_name, v, CASE WHEN v IS NULL THEN NULL
    WHEN regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS INTEGER) IS NOT NULL THEN 'int'
    WHEN regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS BIGINT) IS NOT NULL THEN 'bigint'
    WHEN regexp_full_match(v, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') THEN 'decimal'
    WHEN regexp_full_match(v, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN 'double'
    WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_strptime(v, '%Y-%m-%d') IS NOT NULL THEN 'date'
    ELSE 'string' END AS kind
  FROM field_values
), merged AS (
  SELECT column_name, count(*) FILTER (v IS NULL) AS n_null, count(v) AS n,
    count(*) FILTER (kind = 'int') AS n_int, count(*) FILTER (kind = 'bigint') AS n_bigint,
    count(*) FILTER (kind = 'decimal') AS n_decimal, count(*) FILTER (kind = 'double') AS n_double,
    count(*) FILTER (kind = 'date') AS n_date, count(*) FILTER (kind = 'string') AS n_string,
    max(length(ltrim(regexp_extract(v, '^[+-]?([0-9]*)', 1), '0'))) FILTER (kind IN ('int', 'bigint', 'decimal')) AS whole,
    max(length(regexp_extract(v, '[.]([0-9]*)$', 1))) FILTER (kind IN ('int', 'bigint', 'decimal')) AS behind
  FROM classed GROUP BY column_name
)
SELECT column_name, CASE WHEN n = 0 THEN 'null' WHEN n_date = n THEN 'date' WHEN n_string > 0 OR n_date > 0 THEN 'string'
    WHEN n_double > 0 OR n_decimal > 0 AND whole + behind > 38 THEN 'double'
    WHEN n_decimal > 0 THEN 'decimal(' || greatest(1, whole + behind) || ',' || behind || ')'
    WHEN n_bigint > 0 THEN 'bigint' ELSE 'int' END AS inferred_type,
  n_null, n_int, n_bigint, n_decimal, n_double, n_date, n_string
FROM merged""")

_type_case = ("CASE " + " ".join(f"WHEN p_type = '{k}' THEN '{v}'" for k, v in fx.PART_TYPE_CATEGORY.items())
              + f" ELSE '{fx.OTHER_CATEGORY}' END")
_LOOKUP = with_stage("cleaned", f"""
, margins AS (
  SELECT {_type_case} AS category, CAST((count(*) % 40 + 5) * 0.01 AS DECIMAL(9,6)) AS margin FROM part GROUP BY 1
), aliases AS (
  SELECT {initcap('n_name')} AS city, {initcap('n_name')} || ' ' || n_regionkey AS alias FROM nation
), products AS (
  SELECT {padded_key('PROD', 'p_partkey', 7)} AS product_id, p_brand, p_size
  FROM part
), s AS (
  SELECT transaction_id, product_id, {initcap('trim(category)')} AS category, {initcap('trim(city)')} AS city,
    CAST(round({amount('quantity')}, 2) AS DECIMAL(27,2)) AS revenue
  FROM cleaned
)
SELECT transaction_id, s.category, coalesce(alias, s.city) AS city, coalesce(margin, CAST({DEFAULT_MARGIN} AS DECIMAL(9,6))) AS profit_margin,
  CAST(round(revenue * coalesce(margin, CAST({DEFAULT_MARGIN} AS DECIMAL(9,6))), 2) AS DECIMAL(31,2)) AS profit, p_brand, p_size
FROM s LEFT JOIN margins ON margins.category = s.category LEFT JOIN aliases ON aliases.city = s.city
  LEFT JOIN products ON products.product_id = s.product_id""")

# What DECIMAL(12,2) and the other warehouse columns can't hold after rounding.
_wide = [(c, f"abs(round({c}, {d})) >= {10 ** (p - d)}") for c, p, d in (
    ("unit_price", 10, 2), ("discount", 5, 4), ("total_amount", 12, 2), ("revenue", 12, 2), ("profit", 12, 2))]
_long = [(c, f"length({c}) > {n}") for c, n in WAREHOUSE_TEXT_WIDTHS.items()]
_MISFITS = with_stage("validated", "SELECT transaction_id, CASE WHEN misfit_columns = '' THEN CAST(CAST(revenue AS DECIMAL(12,2)) AS VARCHAR) "
                      "ELSE CAST(revenue AS VARCHAR) END AS revenue, misfit_columns FROM (SELECT *, concat_ws(',', "
                      + ", ".join(f"CASE WHEN {test} THEN '{c}' END" for c, test in _wide + _long) + ") AS misfit_columns FROM validated)")

_REPEATED = f"""
, repeated AS (
  SELECT transaction_id, coalesce(customer_id, 'GUEST_CUSTOMER') AS customer_id, state,
    CAST(round({amount('abs(quantity)')}, 2) AS DECIMAL(27,2)) AS revenue
  FROM sales_raw
)"""

ORACLE: dict[str, str] = {
    # sources
    "csv_routing": _csv(_good_rows),
    "ingest_counts": _csv(f"SELECT {_INGEST} FROM csv_final"),
    "malformed_lines": _csv("""
SELECT line AS malformed_line, CASE WHEN too_few THEN 'too_few_fields' WHEN too_many THEN 'too_many_fields'
  WHEN not_an_integer THEN 'not_an_integer' WHEN not_a_number THEN 'not_a_number' ELSE 'too_wide' END AS reason
FROM csv_final WHERE malformed"""),
    "schema_preview": _csv(_TYPES),
    "numeric_parse": _csv("""
SELECT f_transaction_id AS transaction_id, nullif(f_quantity, '') AS quantity_text,
  TRY_CAST(nullif(f_quantity, '') AS DOUBLE) AS quantity_num,
  TRY_CAST(nullif(f_unit_price, '') AS DOUBLE) AS unit_price_num
FROM csv_lines"""),
    # cleaning
    "dedup_exact": with_stage("deduped", "SELECT * FROM distinct_rows"),
    "dedup_key": with_stage("deduped", "SELECT * FROM deduped"),
    "impute_defaults": with_stage("deduped", """
SELECT * REPLACE (coalesce(customer_id, 'GUEST_CUSTOMER') AS customer_id,
  coalesce(payment_method, 'Not Specified') AS payment_method,
  coalesce(category, 'Uncategorized') AS category,
  coalesce(city, 'Unknown City') AS city)
FROM deduped"""),
    "abs_quantity": with_stage("deduped", "SELECT * REPLACE (CAST(abs(quantity) AS INTEGER) AS quantity) FROM deduped"),
    "parse_dates": with_stage("deduped", """
SELECT * REPLACE (CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date,
  CAST(try_strptime(delivery_date, '%Y-%m-%d') AS DATE) AS delivery_date)
FROM deduped WHERE try_strptime(order_date, '%Y-%m-%d') IS NOT NULL"""),
    "cleaning_stats": with_stage("deduped", f"""
, n AS (
  SELECT (SELECT count(*) FROM sales_raw) AS before, (SELECT count(*) FROM distinct_rows) AS dist,
    count(*) AS kept,
    count(*) FILTER (customer_id IS NULL) AS m_c, count(*) FILTER (payment_method IS NULL) AS m_p,
    count(*) FILTER (category IS NULL) AS m_cat, count(*) FILTER (city IS NULL) AS m_city,
    count(*) FILTER (quantity < 0) AS neg,
    count(*) FILTER (try_strptime(order_date, '%Y-%m-%d') IS NULL) AS bad
  FROM deduped
)
SELECT {_b('before')} AS rows_before_cleaning, {_b('before - dist')} AS exact_duplicate_rows_removed,
  {_b('dist - kept')} AS duplicate_transaction_ids_removed, {_b('m_c')} AS missing_customer_id_imputed,
  {_b('m_p')} AS missing_payment_method_imputed, {_b('m_cat')} AS missing_category_imputed,
  {_b('m_city')} AS missing_city_imputed, {_b('neg')} AS negative_quantities_corrected,
  {_b('bad')} AS invalid_order_dates_dropped, {_b('kept - bad')} AS rows_after_cleaning,
  {_b('before - kept + bad')} AS total_rows_removed
FROM n"""),
    # transform
    "standardize_category": with_stage(
        "cleaned", f"SELECT * REPLACE ({initcap('trim(category)')} AS category) FROM cleaned"),
    "normalize_city": with_stage("cleaned", f"""
, c0 AS (SELECT *, {initcap('trim(city)')} AS city0 FROM cleaned)
SELECT * EXCLUDE (city0) REPLACE (coalesce({_city_alias}, city0) AS city) FROM c0"""),
    "lookup_join": _LOOKUP,
    "lookup_join_split": _LOOKUP,
    "derive_money": with_stage("derived", "SELECT transaction_id, revenue, profit_margin, profit FROM derived"),
    "derive_dates": with_stage("derived", """
SELECT transaction_id, delivery_days, order_month, order_year, order_year_month FROM derived"""),
    "city_label": with_stage("derived", """
SELECT transaction_id, city, state, city || ' (' || state || ')' AS city_label FROM derived"""),
    # validation
    "uniqueness_check": with_stage("derived", f"""
, u AS (SELECT count(*) AS t, count(DISTINCT transaction_id)
          + coalesce(max(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END), 0) AS d FROM derived)
SELECT {_b('t')} AS total_records, {_b('d')} AS distinct_ids, {_b('t - d')} AS duplicate_ids FROM u"""),
    "revenue_flag": with_stage("validated", """
SELECT transaction_id, total_amount, revenue, revenue_consistent FROM validated"""),
    "date_flag": with_stage("validated", """
SELECT transaction_id, order_date, delivery_date, date_integrity_ok FROM validated"""),
    "validation_report": with_stage("validated", f"""
, v AS (SELECT count(*) AS t, count(DISTINCT transaction_id)
          + coalesce(max(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END), 0) AS d,
        count(*) FILTER (NOT revenue_consistent) AS ri, count(*) FILTER (NOT date_integrity_ok) AS dv
        FROM validated)
SELECT {_b('t')} AS total_records_validated, {_b('t - d')} AS duplicate_transaction_ids_found,
  {_b('ri')} AS revenue_inconsistent_records, {pct2('t - ri', 't')} AS pct_revenue_consistent,
  {_b('dv')} AS date_integrity_violations, {pct2('t - dv', 't')} AS pct_date_integrity_ok
FROM v"""),
    "quality_profile": with_stage("sales_raw", f"""
, g_rows AS (SELECT {_raw13}, count(*) AS n FROM sales_raw GROUP BY ALL),
g_ids AS (SELECT transaction_id, count(*) AS n FROM sales_raw GROUP BY transaction_id)
SELECT {_b('count(*) FILTER (customer_id IS NULL)')} AS missing_customer_id,
  {_b('count(*) FILTER (payment_method IS NULL)')} AS missing_payment_method,
  {_b('count(*) FILTER (category IS NULL)')} AS missing_category,
  {_b('count(*) FILTER (city IS NULL)')} AS missing_city,
  {_b('count(*) FILTER (quantity < 0)')} AS negative_quantity,
  {_b('(SELECT coalesce(sum(n), 0) FROM g_rows WHERE n > 1)')} AS duplicate_rows_exact,
  {_b('(SELECT coalesce(sum(n), 0) FROM g_ids WHERE n > 1)')} AS duplicate_transaction_ids
FROM sales_raw"""),
    # reports
    "sales_kpis": with_stage("validated", f"""
SELECT {money('revenue')} AS total_revenue, {_orders} AS total_orders,
  {avg2('revenue')} AS average_order_value, {_b('count(DISTINCT customer_id)')} AS total_customers
FROM validated"""),
    "avg_delivery": with_stage("validated", f"""
SELECT {avg2('delivery_days')} AS avg_delivery_days FROM validated WHERE date_integrity_ok"""),
    "revenue_by_category": with_stage("validated", _cat_report),
    "revenue_by_state": with_stage("validated", f"""
SELECT state, {money('revenue')} AS total_revenue, {_orders} AS total_orders,
  {_b('count(DISTINCT customer_id)')} AS total_customers
FROM validated GROUP BY state"""),
    "monthly_trend": with_stage("validated", f"""
SELECT order_year, order_month, order_year_month, {money('revenue')} AS total_revenue,
  {_orders} AS total_orders
FROM validated GROUP BY order_year, order_month, order_year_month"""),
    "top_products": with_stage("validated", f"""
SELECT product_id, category, {money('revenue')} AS total_revenue,
  {_b('sum(quantity)')} AS total_units_sold
FROM validated GROUP BY product_id, category
ORDER BY total_revenue DESC, product_id, category LIMIT 10"""),
    "top_cities": with_stage("validated", f"""
SELECT city, state, {money('revenue')} AS total_revenue
FROM validated GROUP BY city, state
ORDER BY total_revenue DESC, city, state LIMIT 10"""),
    "rollup_kpis": with_stage("sales_raw", _REPEATED + f"""
SELECT {money('revenue')} AS total_revenue, {_orders} AS total_orders, {avg2('revenue')} AS average_order_value,
  {_b('count(DISTINCT customer_id)')} AS total_customers FROM repeated"""),
    "rollup_by_state": with_stage("sales_raw", _REPEATED + f"""
SELECT state, {money('revenue')} AS total_revenue, {_orders} AS total_orders,
  {_b('count(DISTINCT customer_id)')} AS total_customers FROM repeated GROUP BY state"""),
    "customer_summary": with_stage("validated", f"""
SELECT customer_id, {_orders} AS total_orders, {money('revenue')} AS total_revenue,
  {avg2('revenue')} AS avg_order_value, max(order_date) AS last_order_date
FROM validated GROUP BY customer_id"""),
    "kpi_long": with_stage("validated", f"""
, k AS (
  SELECT {money('revenue')} AS total_revenue, {_orders} AS total_orders,
    {avg2('revenue')} AS average_order_value, {_b('count(DISTINCT customer_id)')} AS total_customers,
    {avg2('CASE WHEN date_integrity_ok THEN delivery_days END')} AS average_delivery_days
  FROM validated
)
""" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS kpi, CAST({c} AS DECIMAL(38,2)) AS value FROM k" for c in _kpi_cols)),
    # SQL report set
    "sql_monthly": with_stage("validated", f"""
SELECT order_year, order_month, order_year_month, {money('revenue')} AS total_revenue,
  {_orders} AS total_orders
FROM validated GROUP BY order_year, order_month, order_year_month"""),
    "sql_best_category": with_stage("validated", _cat_report + " ORDER BY total_revenue DESC, category LIMIT 1"),
    "sql_category_rank": with_stage("validated", f"""
SELECT category, {money('revenue')} AS total_revenue, {money('profit')} AS total_profit
FROM validated GROUP BY category"""),
    "sql_top_customers": with_stage("validated", f"""
SELECT customer_id, {_orders} AS total_orders, {money('revenue')} AS total_revenue,
  {avg2('revenue')} AS avg_order_value
FROM validated WHERE customer_id <> 'GUEST_CUSTOMER' GROUP BY customer_id
ORDER BY total_revenue DESC, customer_id LIMIT 5"""),
    "sql_state": with_stage("validated", f"""
SELECT state, {money('revenue')} AS total_revenue, {_orders} AS total_orders,
  {_b('count(DISTINCT customer_id)')} AS total_customers
FROM validated GROUP BY state"""),
    "sql_delivery": with_stage("validated", f"""
SELECT {avg2('delivery_days')} AS avg_delivery_days, min(delivery_days) AS min_delivery_days,
  max(delivery_days) AS max_delivery_days
FROM validated WHERE delivery_days >= 0"""),
    # the end-to-end run from CSV text
    "pipeline_stats": _CSV_RUN + """
, n AS (
  SELECT (SELECT count(*) FROM csv_final) AS lines, (SELECT count(*) FROM csv_final WHERE malformed) AS malformed,
""" + "\n".join(f"    (SELECT count(*) FROM csv_final WHERE {flag}) AS {flag}," for _, flag in _kinds) + """
    (SELECT count(*) FROM sales_raw) AS before, (SELECT count(*) FROM distinct_rows) AS dist,
    count(*) AS kept, count(*) FILTER (customer_id IS NULL) AS m_c, count(*) FILTER (payment_method IS NULL) AS m_p,
    count(*) FILTER (category IS NULL) AS m_cat, count(*) FILTER (city IS NULL) AS m_city,
    count(*) FILTER (quantity < 0) AS neg, count(*) FILTER (try_strptime(order_date, '%Y-%m-%d') IS NULL) AS bad
  FROM deduped
), v AS (
  SELECT count(*) AS t, count(*) FILTER (NOT revenue_consistent) AS ri, count(*) FILTER (NOT date_integrity_ok) AS dv,
    count(*) - count(DISTINCT transaction_id) AS dup FROM validated
)
""" + "\nUNION ALL\n".join(
        f"SELECT '{stage}' AS stage, '{key}' AS measure, CAST({x} AS DECIMAL(38,2)) AS value FROM {src}"
        for stage, src, pairs in (
            ("ingest", "n", {"total_records": "lines", "malformed_records": "malformed", "usable_records": "lines - malformed",
                             **{f"{kind}_records": flag for kind, flag in _kinds}, "unreadable_records": "0"}),
            ("cleaning", "n", {
                "rows_before_cleaning": "before", "exact_duplicate_rows_removed": "before - dist",
                "duplicate_transaction_ids_removed": "dist - kept", "missing_customer_id_imputed": "m_c",
                "missing_payment_method_imputed": "m_p", "missing_category_imputed": "m_cat",
                "missing_city_imputed": "m_city", "negative_quantities_corrected": "neg",
                "invalid_order_dates_dropped": "bad", "rows_after_cleaning": "kept - bad",
                "total_rows_removed": "before - kept + bad"}),
            ("validation", "v", {
                "total_records_validated": "t", "duplicate_transaction_ids_found": "dup",
                "revenue_inconsistent_records": "ri", "pct_revenue_consistent": pct2("t - ri", "t"),
                "date_integrity_violations": "dv", "pct_date_integrity_ok": pct2("t - dv", "t")}))
        for key, x in pairs.items()),
    "pipeline_csv_reports": _CSV_RUN + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS report, {key} AS name, {money('revenue')} AS total_revenue, {_orders} AS total_orders "
        f"FROM validated GROUP BY {key}"
        for name, key in (("category", "category"), ("state", "state"), ("month", "order_year_month"), ("customer", "customer_id"))),
    "incremental_reports": _CSV_RUN + "\n" + _cat_report,
    # sinks
    "processed_versions": with_stage("validated", "SELECT * FROM validated"),
    "misfit_split": _MISFITS,
    "processed_table": with_stage("validated", "SELECT * FROM validated"),
    "report_roundtrip": with_stage("validated", _cat_report),
}
