"""JDBC sink (K5, K6).

Not exercised against a database in this repository: the test environment may
not start database servers, so only the option building and column selection
are tested. The write itself is Spark's JDBC data source.
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schema import INTERNAL_COLUMNS

log = logging.getLogger("ledgerline.jdbc")

# --- Fixed values: text column widths of the source job's warehouse table. ----
WAREHOUSE_TEXT_WIDTHS = {
    "transaction_id": 20,
    "customer_id": 20,
    "product_id": 20,
    "category": 50,
    "city": 50,
    "state": 50,
    "payment_method": 30,
    "order_year_month": 7,
}
WAREHOUSE_DECIMALS = {"unit_price": "decimal(10,2)", "discount": "decimal(5,4)", "total_amount": "decimal(12,2)",
                      "revenue": "decimal(12,2)", "profit": "decimal(12,2)"}
URL_OPTIONS = "useSSL=false&allowPublicKeyRetrieval=true"
DEFAULT_CONNECTION = {
    "host": "localhost",
    "port": "3306",
    "database": "retail_sales_db",
    "user": "root",
    "password": "",
}
# --- end of fixed values -------------------------------------------------------

# Connections at a time; a write task holds one.
CONNECTIONS = 8
# Names beside the target while it is published, and of the rows that don't fit.
LOADING, BEFORE, MISFITS = "__load", "__before", "_misfits"


def connection_from_env(prefix: str = "MYSQL_", defaults: dict[str, str] | None = None) -> dict[str, str]:
    """K6: ``{prefix}HOST``, ``PORT``, ``DATABASE``, ``USER``, ``PASSWORD``, with defaults."""
    base = dict(DEFAULT_CONNECTION if defaults is None else defaults)
    return {k: os.environ.get(f"{prefix}{k.upper()}", v) for k, v in base.items()}


def mysql_url(conn: dict[str, str], options: str = URL_OPTIONS) -> str:
    address = "jdbc:mysql://{host}:{port}/{database}".format(**conn)
    return f"{address}?{options}" if options else address


def _narrow(columns: list[str]) -> dict[str, Column]:
    return {c: F.col(c).try_cast(t) for c, t in WAREHOUSE_DECIMALS.items() if c in columns}


def warehouse_frame(df: DataFrame) -> DataFrame:
    """The 19 warehouse columns at the warehouse's widths, without the pipeline's own.
    A number too large for its column becomes NULL; ``too_wide`` counts them."""
    return df.withColumns(_narrow(df.columns)).drop(*INTERNAL_COLUMNS)


def too_wide(df: DataFrame) -> DataFrame:
    """One row: per decimal column the values that its warehouse column can't hold."""
    return df.agg(*[F.count_if(F.col(c).isNotNull() & narrow.isNull()).alias(c)
                    for c, narrow in _narrow(df.columns).items()])


def jdbc_options(columns: list[str], url: str, table: str, user: str | None = None,
                 password: str | None = None, driver: str | None = None,
                 truncate: bool = True, batch_size: int = 10000) -> dict[str, str]:
    """Writer options of K5. ``createTableColumnTypes`` gives the text columns
    their warehouse widths whenever Spark has to create the table (decimals
    already map to the same DECIMAL types)."""
    widths = ", ".join(f"{c} VARCHAR({n})" for c, n in WAREHOUSE_TEXT_WIDTHS.items() if c in columns)
    opts = {"url": url, "dbtable": table, "truncate": str(truncate).lower(),
            "batchsize": str(batch_size), "createTableColumnTypes": widths,
            "user": user, "password": password, "driver": driver}
    return {k: v for k, v in opts.items() if v}


def split_misfits(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the warehouse frame of the rows that fit, the other rows). Misfits are whole: every warehouse
    column as text, and ``misfit_columns`` names what doesn't fit. Texts longer than their column
    count as well."""
    narrow = _narrow(df.columns)
    wrong = [F.when(F.col(c).isNotNull() & v.isNull(), F.lit(c)) for c, v in narrow.items()]
    wrong += [F.when(F.length(c) > n, F.lit(c)) for c, n in WAREHOUSE_TEXT_WIDTHS.items() if c in df.columns]
    named = df.withColumn("misfit_columns", F.array_join(F.array_compact(F.array(*wrong)), ","))
    fits = warehouse_frame(named.filter("misfit_columns = ''").drop("misfit_columns"))
    misfits = named.filter("misfit_columns != ''").drop(*INTERNAL_COLUMNS)
    return fits, misfits.select(*[F.col(c).cast("string").alias(c) for c in misfits.columns])


def quoted(table: str) -> str:
    """A table name, maybe with its schema, in MySQL's quotes."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in table.split("."))


def before_load(table: str, exists: bool) -> list[str]:
    """Statements before the load. The side table copies the target's DDL (types, key, indexes) where there
    is one; a left-over of a load that failed goes."""
    side = quoted(table + LOADING)
    return [f"DROP TABLE IF EXISTS {side}", *([f"CREATE TABLE {side} LIKE {quoted(table)}"] if exists else [])]


def swap(table: str, exists: bool) -> list[str]:
    """Statements after the load is checked. RENAME TABLE moves both names in one step, so a reader sees
    the old table or the new one, whole."""
    side, old = quoted(table + LOADING), quoted(table + BEFORE)
    if not exists:
        return [f"RENAME TABLE {side} TO {quoted(table)}"]
    return [f"DROP TABLE IF EXISTS {old}", f"RENAME TABLE {quoted(table)} TO {old}, {side} TO {quoted(table)}",
            f"DROP TABLE {old}"]


class Warehouse:
    """What a published load needs of a database, over one JDBC address."""

    def __init__(self, spark: SparkSession, url: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, num_partitions: int = CONNECTIONS, batch_size: int = 10000):
        self.spark, self.url, self.user, self.password, self.driver = spark, url, user, password, driver
        self.num_partitions, self.batch_size = num_partitions, batch_size

    def connection(self):
        jvm = self.spark.sparkContext._jvm
        if self.driver:
            jvm.org.apache.spark.util.Utils.classForName(self.driver, True, True)
        return jvm.java.sql.DriverManager.getConnection(self.url, self.user, self.password)

    def run(self, statements: list[str]) -> None:
        connection = self.connection()
        try:
            for text in statements:
                statement = connection.createStatement()
                statement.execute(text)
                statement.close()
        finally:
            connection.close()

    def exists(self, table: str) -> bool:
        schema, _, name = table.rpartition(".")
        connection = self.connection()
        try:
            found = connection.getMetaData().getTables(schema or connection.getCatalog(), None, name, None)
            return bool(found.next())
        finally:
            connection.close()

    def rows(self, table: str) -> int:
        options = {k: v for k, v in (("user", self.user), ("password", self.password), ("driver", self.driver)) if v}
        text = f"(SELECT count(*) AS n FROM {quoted(table)}) AS counted"
        return int(self.spark.read.format("jdbc").options(url=self.url, dbtable=text, **options).load().first()[0])

    def load(self, df: DataFrame, table: str, mode: str) -> None:
        opts = jdbc_options(df.columns, self.url, table, self.user, self.password, self.driver, False, self.batch_size)
        df.coalesce(self.num_partitions).write.format("jdbc").mode(mode).options(**opts).save()


def publish(df: DataFrame, warehouse: Warehouse, table: str) -> tuple[int, int]:
    """K5 in one step for readers: the rows that fit go to a side table, which takes the target's name once
    it holds as many rows as the frame; those that don't go whole to ``<table>_misfits`` in the same way.
    A load that fails, or whose count is wrong (a write task that ran twice, say), leaves the
    target as it was. Returns the numbers of rows (loaded, misfits)."""
    counts = []
    for rows, name in zip(split_misfits(df), (table, table + MISFITS)):
        expected = rows.count()
        exists = warehouse.exists(name)
        if not expected and name != table and not exists:
            counts.append(0)
            continue
        warehouse.run(before_load(name, exists))
        warehouse.load(rows, name + LOADING, "append")
        found = warehouse.rows(name + LOADING)
        if found != expected:
            raise RuntimeError(f"{found} rows in {name}{LOADING}, {expected} were to be loaded; {table} is unchanged")
        counts.append((expected, name, exists))
    for done in counts:
        if done:
            warehouse.run(swap(done[1], done[2]))
    loaded, misfits = (done[0] if done else 0 for done in counts)
    log.info("%d rows published as %s, %d misfits", loaded, table, misfits)
    return loaded, misfits


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
               password: str | None = None, driver: str | None = None,
               truncate: bool = True, num_partitions: int = CONNECTIONS,
               batch_size: int = 10000, published: bool = False) -> int:
    """K5: overwrite ``table``. ``truncate`` keeps the existing DDL (decimal types,
    key, indexes) instead of re-creating the table from Spark's inferred types.
    ``num_partitions`` bounds the connections to the database. ``published`` (MySQL):
    by ``publish``, whole or not at all, and rows that don't fit to a table of their
    own instead of as NULL. Returns the number of rows, and logs it with the values
    that didn't fit."""
    if published:
        return sum(publish(df, Warehouse(df.sparkSession, url, user, password, driver, num_partitions, batch_size), table))
    misfits = {c: n for c, n in too_wide(df).first().asDict().items() if n}
    if misfits:
        log.warning("values too large for the warehouse, loaded as NULL: %s", misfits)
    out = warehouse_frame(df).coalesce(num_partitions)
    opts = jdbc_options(out.columns, url, table, user, password, driver, truncate, batch_size)
    out.write.format("jdbc").mode("overwrite").options(**opts).save()
    rows = df.count()
    log.info("%d rows loaded into %s", rows, table)
    return rows
