"""Transformation (T1-T9): standardise text dimensions, derive measures.

All derived columns are added in one projection so Catalyst sees a single
Project (no chain of ``withColumn`` plans to collapse).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import lookups as L
from ledgerline.schema import MARGIN

# A literal map, a two-column frame (key, value), or one that ``lookups.prepared`` has written.
Table = Mapping[str, str] | DataFrame | L.Lookup


def standardize_category(df: DataFrame) -> DataFrame:
    """T1."""
    return df.withColumn("category", C.standardize_category("category"))


def normalize_city(df: DataFrame, aliases: Table = C.DEFAULT_CITY_ALIASES, limit: int = L.BROADCAST_BYTES,
                   hot: DataFrame | None = None) -> DataFrame:
    """T2. Aliases in a table are joined (``operators.lookups``); ``limit`` and ``hot`` as there."""
    if not L.is_table(aliases):
        return df.withColumn("city", C.normalize_city("city", aliases))
    found = L.attach(df.withColumn("city", C.normalize_city("city", {})), L.as_lookup(aliases), F.col("city"), "_alias", limit, hot)
    return found.withColumn("city", F.coalesce(value_of("_alias", found), F.col("city"))).drop("_alias")


def value_of(name: str, df: DataFrame) -> Column:
    """The first value of an attached struct."""
    return F.col(name)[df.schema[name].dataType.fields[0].name]


def add_derived_columns(df: DataFrame, margins: Table = C.DEFAULT_CATEGORY_MARGINS,
                        default_margin: str = C.DEFAULT_MARGIN, limit: int = L.BROADCAST_BYTES,
                        hot: DataFrame | None = None) -> DataFrame:
    """Revenue, profit_margin, profit, delivery_days, order_month,
    order_year, order_year_month. Profit uses the rounded revenue. Margins in a
    table are joined on the category."""
    columns, margin = df.columns, None
    if L.is_table(margins):
        df = L.attach(df, L.as_lookup(margins), F.col("category"), "_margin", limit, hot)
        margin = F.coalesce(value_of("_margin", df).cast(MARGIN), F.lit(default_margin).cast(MARGIN))
    else:
        margin = C.profit_margin("category", margins, default_margin)
    rev = C.revenue()
    return df.select(
        *[F.col(f"`{c}`") for c in columns],
        rev.alias("revenue"),
        margin.alias("profit_margin"),
        C.profit(rev, margin).alias("profit"),
        C.delivery_days().alias("delivery_days"),
        C.order_month().alias("order_month"),
        C.order_year().alias("order_year"),
        C.order_year_month().alias("order_year_month"),
    )


def hot_lookup_keys(raw: DataFrame, margins: Table, aliases: Table, limit: int = L.BROADCAST_BYTES) -> dict[str, DataFrame]:
    """``hot_keys`` (by lookup) of raw rows, for those lookups that are too large to broadcast."""
    on = {"margins": (margins, C.standardize_category(F.coalesce("category", F.lit(C.NO_CATEGORY)))),
          "aliases": (aliases, C.normalize_city(F.coalesce("city", F.lit(C.NO_CITY)), {}))}
    return {name: L.hot_keys(raw, key) for name, (source, key) in on.items()
            if isinstance(source, L.Lookup) and not source.small(limit)}


def transform_data(df: DataFrame, margins: Table = C.DEFAULT_CATEGORY_MARGINS, aliases: Table = C.DEFAULT_CITY_ALIASES,
                   default_margin: str = C.DEFAULT_MARGIN, limit: int = L.BROADCAST_BYTES,
                   hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """T1, T2, then T3-T8 (margins are looked up on the standardised category).
    ``hot``: ``hot_lookup_keys``, if they are to be measured on other rows than these."""
    hot = hot or {}
    if not L.is_table(aliases):
        std = df.withColumns({
            "category": C.standardize_category("category"),
            "city": C.normalize_city("city", aliases),
        })
    else:
        std = normalize_city(standardize_category(df), aliases, limit, hot.get("aliases"))
    return add_derived_columns(std, margins, default_margin, limit, hot.get("margins"))


def city_labels(df: DataFrame) -> DataFrame:
    """Add ``city_label`` = ``city (state)``."""
    return df.withColumn("city_label", C.city_label())


def parse_numeric(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Tolerant numeric parse of text columns (name -> target type)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in columns.items()})
