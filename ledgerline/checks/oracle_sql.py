"""Independent SQL (DuckDB dialect) of the fixture view and every stage.

Used only as the correctness oracle: each Spark query in ``__spark_entry__``
has a SQL twin built from these CTEs over the driver's registered tables
(``lineitem orders customer nation region part``). Outputs end in the same
explicit types as the Spark side: money sums DECIMAL(38,2), averages
DECIMAL(18,2), counts BIGINT, date parts INTEGER.
"""

from __future__ import annotations

from ledgerline.functions.columns import (
    DEFAULT_CATEGORY_MARGINS,
    DEFAULT_CITY_ALIASES,
    DEFAULT_MARGIN,
)
from ledgerline.schema import RAW_COLUMNS
from ledgerline.sources import fixture as fx


def _case(expr: str, mapping: dict[str, str], default: str, quote_values: bool = True) -> str:
    whens = " ".join(
        f"WHEN {expr} = '{k}' THEN " + (f"'{v}'" if quote_values else v) for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def initcap(x: str) -> str:
    """Spark's initcap: split on single spaces, upper first letter, lower the rest."""
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: concat(upper(substr(w, 1, 1)), lower(substr(w, 2)))), ' ')")


def avg2(x: str) -> str:
    """round(avg(x), 2), exact, half away from zero, in integer hundredths."""
    n = f"count({x})"
    q = f"((2 * abs(CAST(sum({x}) * 100 AS HUGEINT)) + {n}) // (2 * {n}))"
    return (f"CASE WHEN {n} > 0 THEN CAST(CAST((CASE WHEN sum({x}) < 0 THEN -1 ELSE 1 END) * {q} "
            f"AS DECIMAL(28,0)) * 0.01 AS DECIMAL(30,2)) END")


def pct2(part: str, whole: str) -> str:
    return (f"CASE WHEN {whole} > 0 THEN CAST(CAST((20000 * CAST({part} AS HUGEINT) + {whole}) "
            f"// (2 * {whole}) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(5,2)) END")


def money(x: str) -> str:
    return f"CAST(round(sum({x}), 2) AS DECIMAL(38,2))"


_cat = ("CASE l.l_partkey % 13 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in fx.PART_KEY_CATEGORY.items())
        + " ELSE " + _case("p.p_type", fx.PART_TYPE_CATEGORY, f"'{fx.OTHER_CATEGORY}'") + " END")


def amount(quantity: str) -> str:
    """quantity * price * (1 - discount); DuckDB stays at 18 digits unless an operand has more."""
    return f"CAST({quantity} * CAST(unit_price AS DECIMAL(19,6)) AS DECIMAL(26,6)) * (1 - discount)"


def _key(prefix: str, x: str, width: int) -> str:
    """Prefix and number, with zeros only where the number is shorter than ``width``."""
    t = f"CAST({x} AS VARCHAR)"
    return f"'{prefix}' || repeat('0', greatest(0, {width} - length({t}))) || {t}"



_city_variants = " ".join(f"WHEN o.o_custkey % 20 = {k} THEN '{v}'" for k, v in fx.CITY_VARIANTS.items())
_bad_dates = " ".join(f"WHEN l.l_orderkey % {m} = 0 THEN '{v}'" for m, v in fx.BAD_ORDER_DATES)

BASE = f"""
fx_base AS (
  SELECT l.l_orderkey, l.l_linenumber,
    {_key('TXN', 'l.l_orderkey', 9)} || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
    CASE WHEN o.o_custkey % 50 = 0 THEN NULL ELSE {_key('CUST', 'o.o_custkey', 7)} END AS customer_id,
    {_key('PROD', 'l.l_partkey', 7)} AS product_id,
    {_cat} AS cat,
    CASE WHEN o.o_custkey % 71 = 0 THEN NULL {_city_variants} ELSE n.n_name END AS city,
    r.r_name AS state,
    CASE WHEN l.l_partkey % 101 = 0 THEN -CAST(l.l_quantity AS INTEGER) ELSE CAST(l.l_quantity AS INTEGER) END AS quantity,
    CAST(l.l_quantity AS INTEGER) AS qty_pos,
    CAST(l.l_extendedprice AS DECIMAL(15,6)) AS unit_price,
    CAST(l.l_discount AS DECIMAL(9,6)) AS discount,
    CASE WHEN l.l_orderkey % 59 = 0 THEN NULL ELSE o.o_orderpriority END AS payment_method,
    CASE {_bad_dates} ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS order_date,
    CASE WHEN l.l_orderkey % 113 = 0 THEN NULL ELSE strftime(l.l_shipdate, '%Y-%m-%d') END AS delivery_date
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
fx_rows AS (
  SELECT l_orderkey, l_linenumber, transaction_id, customer_id, product_id,
    CASE WHEN l_orderkey % 67 = 0 THEN NULL
         WHEN l_orderkey % 31 = 0 THEN lower(cat)
         WHEN l_orderkey % 37 = 0 THEN '  ' || upper(cat) || ' '
         ELSE cat END AS category,
    city, state, quantity, unit_price, discount,
    CASE WHEN l_orderkey % 97 = 0 THEN CAST({fx.WRONG_TOTAL} AS DECIMAL(24,6))
         ELSE CAST(round({amount('qty_pos')}, 2) AS DECIMAL(24,6)) END AS total_amount,
    payment_method, order_date, delivery_date
  FROM fx_base
),
fx_keyed AS (
  SELECT * FROM fx_rows
  UNION ALL
  SELECT * FROM fx_rows WHERE l_orderkey % 89 = 0
)"""
RAW = f"sales_raw AS (SELECT {', '.join(RAW_COLUMNS)} FROM fx_keyed)"

_others = [c for c in RAW_COLUMNS if c != "transaction_id"]
_order = ", ".join(f"{c} ASC NULLS FIRST" for c in _others)

DEDUP = f"""
distinct_rows AS (SELECT DISTINCT * FROM sales_raw),
deduped AS (
  SELECT * FROM distinct_rows
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {_order}) = 1
)"""

CLEAN = """
cleaned AS (
  SELECT transaction_id,
    coalesce(customer_id, 'GUEST_CUSTOMER') AS customer_id,
    product_id,
    coalesce(category, 'Uncategorized') AS category,
    coalesce(city, 'Unknown City') AS city,
    state,
    CAST(abs(quantity) AS INTEGER) AS quantity,
    unit_price, discount, total_amount,
    coalesce(payment_method, 'Not Specified') AS payment_method,
    CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date,
    CAST(try_strptime(delivery_date, '%Y-%m-%d') AS DATE) AS delivery_date
  FROM deduped
  WHERE try_strptime(order_date, '%Y-%m-%d') IS NOT NULL
)"""

_city_alias = _case("city0", DEFAULT_CITY_ALIASES, "NULL")
_margin = _case("category", DEFAULT_CATEGORY_MARGINS, DEFAULT_MARGIN, quote_values=False)

TRANSFORM = f"""
std AS (
  SELECT * REPLACE ({initcap('trim(category)')} AS category),
    {initcap('trim(city)')} AS city0
  FROM cleaned
),
transformed AS (
  SELECT transaction_id, customer_id, product_id, category,
    coalesce({_city_alias}, city0) AS city,
    state, quantity, unit_price, discount, total_amount, payment_method, order_date, delivery_date,
    CAST(round({amount('quantity')}, 2) AS DECIMAL(27,2)) AS revenue,
    CAST({_margin} AS DECIMAL(9,6)) AS profit_margin
  FROM std
),
derived AS (
  SELECT *,
    CAST(round(revenue * profit_margin, 2) AS DECIMAL(31,2)) AS profit,
    CAST(delivery_date - order_date AS INTEGER) AS delivery_days,
    CAST(month(order_date) AS INTEGER) AS order_month,
    CAST(year(order_date) AS INTEGER) AS order_year,
    strftime(order_date, '%Y-%m') AS order_year_month
  FROM transformed
)"""

VALIDATE = """
validated AS (
  SELECT *,
    abs(total_amount - revenue) < 1.0 AS revenue_consistent,
    delivery_date >= order_date AS date_integrity_ok
  FROM derived
)"""

STAGES = {
    "sales_raw": [BASE, RAW],
    "deduped": [BASE, RAW, DEDUP],
    "cleaned": [BASE, RAW, DEDUP, CLEAN],
    "derived": [BASE, RAW, DEDUP, CLEAN, TRANSFORM],
    "validated": [BASE, RAW, DEDUP, CLEAN, TRANSFORM, VALIDATE],
}


def with_stage(stage: str, body: str) -> str:
    """``WITH <ctes up to stage> <body>``; extra CTEs may open ``body`` with a comma."""
    ctes = ",".join(STAGES[stage])
    if body.lstrip().startswith(","):
        return f"WITH {ctes}{body}"
    return f"WITH {ctes}\n{body}"
