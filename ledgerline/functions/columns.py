"""Scalar column expressions (T1-T8, T10, T11) and exact rounding helpers.

Everything here is a built-in Catalyst expression, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schema import AMOUNT, MARGIN, MONEY_AVG, MONEY_SUM, PROFIT

# --- Fixed values: these must equal the source job's for equal results. ------
# Category -> assumed profit margin (no cost column exists, profit is modelled).
DEFAULT_CATEGORY_MARGINS: dict[str, str] = {
    "Electronics": "0.12",
    "Clothing": "0.35",
    "Footwear": "0.30",
    "Grocery": "0.08",
    "Furniture": "0.18",
    "Beauty & Personal Care": "0.40",
    "Sports & Fitness": "0.25",
    "Books & Stationery": "0.20",
    "Home Decor": "0.28",
    "Toys & Games": "0.30",
    "Uncategorized": "0.15",
}
# Margin for a category missing from the table.
DEFAULT_MARGIN = "0.15"
# Legacy city name -> canonical city name (keys in initcap form).
DEFAULT_CITY_ALIASES: dict[str, str] = {
    "Bombay": "Mumbai",
    "Calcutta": "Kolkata",
    "Bengaluru": "Bangalore",
    "Madras": "Chennai",
    "New Delhi": "Delhi",
}
# Placeholders written over NULLs during cleaning.
GUEST_CUSTOMER = "GUEST_CUSTOMER"
NO_PAYMENT_METHOD = "Not Specified"
NO_CATEGORY = "Uncategorized"
NO_CITY = "Unknown City"
DATE_FORMAT = "yyyy-MM-dd"
YEAR_MONTH_FORMAT = "yyyy-MM"
# Revenue check: |total_amount - revenue| must be strictly below this.
REVENUE_TOLERANCE = "1.0"
# --- end of fixed values -------------------------------------------------------

INT_MIN = -(2 ** 31)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_string(v: str) -> str:
    """A Spark SQL string literal for ``v`` (quotes and backslashes escaped)."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lookup(mapping: Mapping[str, str], key: Column | str, value_type: str = "string") -> Column:
    """Literal map lookup; a missing key gives NULL. Constant-folded by Catalyst.

    The map is one SQL expression (a single JVM call) rather than a Column per
    key and value; the plan is the same."""
    if not mapping:
        return F.lit(None).cast(value_type)
    pairs = ", ".join(f"{sql_string(k)}, CAST({sql_string(v)} AS {value_type})" for k, v in mapping.items())
    return F.try_element_at(F.expr(f"map({pairs})"), _col(key))


def parse_date(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text to DATE; anything unparseable is NULL (never raises)."""
    return F.try_to_date(_col(c), DATE_FORMAT)


def abs_quantity(c: Column | str) -> Column:
    """Sign-error fix. The one INT whose absolute value does not fit becomes NULL
    instead of failing the whole job under ANSI."""
    q = _col(c)
    return F.when(q == F.lit(INT_MIN), F.lit(None).cast("int")).otherwise(F.abs(q))


def standardize_category(c: Column | str = "category") -> Column:
    """initcap(trim(x))."""
    return F.initcap(F.trim(_col(c)))


def normalize_city(c: Column | str = "city",
                   aliases: Mapping[str, str] = DEFAULT_CITY_ALIASES) -> Column:
    """initcap(trim(x)), then legacy alias -> canonical name; others pass."""
    x = F.initcap(F.trim(_col(c)))
    return F.coalesce(lookup(aliases, x), x)


def revenue(quantity: Column | str = "quantity", unit_price: Column | str = "unit_price",
            discount: Column | str = "discount") -> Column:
    """round(qty * price * (1 - discount), 2), exact decimal, HALF_UP."""
    q, p, d = _col(quantity), _col(unit_price), _col(discount)
    return F.round(q * p * (F.lit(Decimal(1)) - d), 2).cast(AMOUNT)


def profit_margin(category: Column | str = "category",
                  margins: Mapping[str, str] = DEFAULT_CATEGORY_MARGINS,
                  default: str = DEFAULT_MARGIN) -> Column:
    """T4: category margin, default when the category is not in the table."""
    return F.coalesce(lookup(margins, category, MARGIN.simpleString()),
                      F.lit(Decimal(default)).cast(MARGIN))


def profit(revenue_col: Column | str = "revenue", margin: Column | str = "profit_margin") -> Column:
    """T5: round(revenue * margin, 2) from the already rounded revenue."""
    return F.round(_col(revenue_col) * _col(margin), 2).cast(PROFIT)


def delivery_days(delivery: Column | str = "delivery_date",
                  order: Column | str = "order_date") -> Column:
    """Days from order to delivery; negative when delivery precedes order."""
    return F.datediff(_col(delivery), _col(order))


def order_month(c: Column | str = "order_date") -> Column:
    return F.month(_col(c))


def order_year(c: Column | str = "order_date") -> Column:
    return F.year(_col(c))


def order_year_month(c: Column | str = "order_date") -> Column:
    """``yyyy-MM`` text of the order date."""
    return F.date_format(_col(c), YEAR_MONTH_FORMAT)


def numeric_parse(c: Column | str, to: str = "double") -> Column:
    """Tolerant numeric parse, NULL for text that is not a number."""
    return _col(c).try_cast(to)


def city_label(city: Column | str = "city", state: Column | str = "state") -> Column:
    """``city (state)`` chart label."""
    return F.concat(_col(city), F.lit(" ("), _col(state), F.lit(")"))


# --- Exact rounding ---------------------------------------------------------
# round(avg(x), 2) through a DECIMAL average rounds twice (to the average's
# scale, then to 2 places); these round the exact quotient once, half away
# from zero, in integer hundredths. Inputs must have at most 2 decimals.

def avg_half_up_sql(x: str) -> str:
    """SQL text of round(avg(x), 2) computed exactly; NULL on no rows."""
    total = f"sum(CAST({x} AS {MONEY_SUM.upper()}))"
    n = f"count({x})"
    a = f"CAST(200 * abs({total}) + {n} AS DECIMAL(38,0))"
    # a less its remainder divides without one (``div`` would end in a BIGINT)
    q = f"CAST(({a} - {a} % (2 * {n})) / (2 * {n}) AS DECIMAL(36,0))"
    return (f"CASE WHEN {n} > 0 THEN CAST((CASE WHEN {total} < 0 THEN -1 ELSE 1 END) * {q} "
            f"* 0.01 AS {MONEY_AVG.upper()}) END")


def avg_half_up(x: str) -> Column:
    return F.expr(avg_half_up_sql(x))


def pct_half_up_sql(part: str, whole: str) -> str:
    """SQL text of round(100 * part / whole, 2) computed exactly; NULL if whole is 0."""
    return (f"CASE WHEN {whole} > 0 THEN CAST(((20000 * CAST({part} AS DECIMAL(38,0)) + {whole}) "
            f"div (2 * {whole})) * 0.01 AS DECIMAL(5,2)) END")


def pct_half_up(part: str, whole: str) -> Column:
    return F.expr(pct_half_up_sql(part, whole))
