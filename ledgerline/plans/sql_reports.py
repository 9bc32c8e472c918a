"""The SQL report set (A10-A15) as Spark SQL over a bound frame.

``spark.sql(text, sales=df)`` binds the frame without registering a global
view name, so concurrent callers do not overwrite each other's ``retail_sales``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.functions.columns import GUEST_CUSTOMER, avg_half_up_sql
from ledgerline.schema import MONEY_SUM


def _money(x: str) -> str:
    return f"CAST(ROUND(SUM(CAST({x} AS {MONEY_SUM.upper()})), 2) AS {MONEY_SUM.upper()})"


_ORDERS = "CAST(COUNT(DISTINCT transaction_id) AS BIGINT)"
# The same where ids are known to be unique: no Expand, no second shuffle.
_UNIQUE_ORDERS = "CAST(COUNT(transaction_id) AS BIGINT)"

SQL = {
    # A10
    "sql_monthly": f"""
        SELECT order_year, order_month, order_year_month,
               {_money('revenue')} AS total_revenue,
               {_ORDERS} AS total_orders
        FROM {{sales}}
        GROUP BY order_year, order_month, order_year_month
        ORDER BY order_year, order_month""",
    # A11
    "sql_best_category": f"""
        SELECT category,
               {_money('revenue')} AS total_revenue,
               {_money('profit')} AS total_profit,
               {_ORDERS} AS total_orders
        FROM {{sales}}
        GROUP BY category
        ORDER BY total_revenue DESC, category
        LIMIT 1""",
    # A12
    "sql_category_rank": f"""
        SELECT category,
               {_money('revenue')} AS total_revenue,
               {_money('profit')} AS total_profit
        FROM {{sales}}
        GROUP BY category
        ORDER BY total_revenue DESC, category""",
    # Guests left out
    "sql_top_customers": f"""
        SELECT customer_id,
               {_ORDERS} AS total_orders,
               {_money('revenue')} AS total_revenue,
               {avg_half_up_sql('revenue')} AS avg_order_value
        FROM {{sales}}
        WHERE customer_id <> '{GUEST_CUSTOMER}'
        GROUP BY customer_id
        ORDER BY total_revenue DESC, customer_id
        LIMIT 5""",
    # A14
    "sql_state": f"""
        SELECT state,
               {_money('revenue')} AS total_revenue,
               {_ORDERS} AS total_orders,
               CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS total_customers
        FROM {{sales}}
        GROUP BY state
        ORDER BY total_revenue DESC, state""",
    # Deliveries before the order left out
    "sql_delivery": f"""
        SELECT {avg_half_up_sql('delivery_days')} AS avg_delivery_days,
               MIN(delivery_days) AS min_delivery_days,
               MAX(delivery_days) AS max_delivery_days
        FROM {{sales}}
        WHERE delivery_days >= 0""",
}


def run_sql(spark: SparkSession, name: str, sales: DataFrame, unique_ids: bool = False) -> DataFrame:
    text = SQL[name].replace(_ORDERS, _UNIQUE_ORDERS) if unique_ids else SQL[name]
    return spark.sql(text, sales=sales)


def run_all(spark: SparkSession, sales: DataFrame, unique_ids: bool = False) -> dict[str, DataFrame]:
    return {name: run_sql(spark, name, sales, unique_ids) for name in SQL}
