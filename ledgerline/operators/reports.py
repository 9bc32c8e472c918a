"""Aggregate reports (A1-A9) with the DataFrame API.

Every report is a hash aggregate with map-side partial aggregation, so hot
groups (the guest customer, a dominant state or month) are pre-aggregated in
each map task; top-k reports end in TakeOrderedAndProject (k rows per task).

Orders are counted as ``COUNT(DISTINCT transaction_id)``. ``unique_ids=True`` says
that the ids are known to be unique (deduplicated, or measured so): counting
them directly keeps a report to one aggregation without Expand or re-shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import GUEST_CUSTOMER, avg_half_up
from ledgerline.schema import KEY, MONEY_SUM


def money_sum(c: str) -> Column:
    # widened before it is summed
    return F.round(F.sum(F.col(c).cast(MONEY_SUM)), 2).cast(MONEY_SUM)


def order_count(unique_ids: bool = False) -> Column:
    c = F.count(KEY) if unique_ids else F.count_distinct(F.col(KEY))
    return c.cast("bigint")


def sales_kpis(df: DataFrame, unique_ids: bool = False, with_delivery: bool = False) -> DataFrame:
    """A1 (+ A2 when ``with_delivery``): one row of headline KPIs in one pass."""
    cols = [
        money_sum("revenue").alias("total_revenue"),
        order_count(unique_ids).alias("total_orders"),
        avg_half_up("revenue").alias("average_order_value"),
        F.count_distinct(F.col("customer_id")).cast("bigint").alias("total_customers"),
    ]
    if with_delivery:
        cols.append(avg_half_up("CASE WHEN date_integrity_ok THEN delivery_days END")
                    .alias("average_delivery_days"))
    return df.agg(*cols)


def average_delivery_time(df: DataFrame) -> DataFrame:
    """A2: average delivery days over rows that passed the date check (NULL flag excluded)."""
    return df.filter(F.col("date_integrity_ok")).agg(
        avg_half_up("delivery_days").alias("avg_delivery_days"))


def revenue_by_category(df: DataFrame, unique_ids: bool = False) -> DataFrame:
    """A3."""
    return (df.groupBy("category")
              .agg(money_sum("revenue").alias("total_revenue"),
                   money_sum("profit").alias("total_profit"),
                   order_count(unique_ids).alias("total_orders"))
              .orderBy(F.desc("total_revenue"), "category"))


def revenue_by_state(df: DataFrame, unique_ids: bool = False) -> DataFrame:
    """A4: the guest placeholder counts as one customer."""
    return (df.groupBy("state")
              .agg(money_sum("revenue").alias("total_revenue"),
                   order_count(unique_ids).alias("total_orders"),
                   F.count_distinct(F.col("customer_id")).cast("bigint").alias("total_customers"))
              .orderBy(F.desc("total_revenue"), "state"))


def monthly_revenue_trend(df: DataFrame, unique_ids: bool = False) -> DataFrame:
    """A5."""
    return (df.groupBy("order_year", "order_month", "order_year_month")
              .agg(money_sum("revenue").alias("total_revenue"),
                   order_count(unique_ids).alias("total_orders"))
              .orderBy("order_year", "order_month"))


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    """By product and category; ties broken by the group keys."""
    return (df.groupBy("product_id", "category")
              .agg(money_sum("revenue").alias("total_revenue"),
                   F.sum("quantity").cast("bigint").alias("total_units_sold"))
              .orderBy(F.desc("total_revenue"), "product_id", "category")
              .limit(n))


def top_cities_by_revenue(df: DataFrame, n: int = 10) -> DataFrame:
    """A7."""
    return (df.groupBy("city", "state")
              .agg(money_sum("revenue").alias("total_revenue"))
              .orderBy(F.desc("total_revenue"), "city", "state")
              .limit(n))


def customer_summary(df: DataFrame, unique_ids: bool = False, exclude_guest: bool = False) -> DataFrame:
    """One row per customer, globally sorted by revenue (range-partitioned
    sort, never collected). The guest placeholder is one row unless excluded."""
    src = df.filter(F.col("customer_id") != F.lit(GUEST_CUSTOMER)) if exclude_guest else df
    return (src.groupBy("customer_id")
               .agg(order_count(unique_ids).alias("total_orders"),
                    money_sum("revenue").alias("total_revenue"),
                    avg_half_up("revenue").alias("avg_order_value"),
                    F.max("order_date").alias("last_order_date"))
               .orderBy(F.desc("total_revenue"), "customer_id"))


def run_aggregations(df: DataFrame, unique_ids: bool = False, top_n: int = 10) -> dict[str, DataFrame]:
    """Every report as a lazy frame; the KPI row carries A2 as well."""
    return {
        "sales_kpis": sales_kpis(df, unique_ids, with_delivery=True),
        "revenue_by_category": revenue_by_category(df, unique_ids),
        "revenue_by_state": revenue_by_state(df, unique_ids),
        "monthly_revenue_trend": monthly_revenue_trend(df, unique_ids),
        "top_products": top_products(df, top_n),
        "top_cities": top_cities_by_revenue(df, top_n),
        "customer_summary": customer_summary(df, unique_ids),
    }


def kpi_long(kpi_row: DataFrame) -> DataFrame:
    """K4: the one-row KPI frame as ``(kpi, value)`` rows, values DECIMAL(38,2)."""
    cols = kpi_row.columns
    wide = kpi_row.select(*[F.col(c).cast(MONEY_SUM).alias(c) for c in cols])
    return wide.unpivot(ids=[], values=cols, variableColumnName="kpi", valueColumnName="value")
