"""Dirty sales view over the driver's star-schema tables.

The source job ships no raw input, only a seeded single-machine generator.
Here every fault is a pure function of a key of the driver's tables, so the
same rows come out of Spark and of an independent SQL engine, and the view
grows with the tables. Rules are listed in FIXTURES.md section 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schema import PRICE, RATE, RAW_COLUMNS, TOTAL

# --- Fixed values of the fixture (FIXTURES.md section 4 and 5). ---------------
PART_TYPE_CATEGORY = {
    "ECONOMY": "Electronics",
    "SMALL": "Grocery",
    "MEDIUM": "Home Decor",
    "PROMO": "Beauty & Personal Care",
    "STANDARD": "Furniture",
}
OTHER_CATEGORY = "Seasonal"
# Categories that no part type stands for, by l_partkey % 13.
PART_KEY_CATEGORY = {1: "Clothing", 2: "Footwear", 3: "Sports & Fitness", 4: "Books & Stationery", 5: "Toys & Games"}
CITY_VARIANTS = {1: "Bombay", 2: " new delhi", 3: "CALCUTTA ", 4: "Bengaluru", 5: "Madras", 6: "mumbai"}
BAD_ORDER_DATES = [(103, "2023-00-17"), (107, "17/04/2023"), (109, "")]
WRONG_TOTAL = "123.45"
GARBAGE_TOKENS = ["?", "missing", "1O2", "--", "NaN%"]
# CSV faults, by l_orderkey modulus: token in quantity, token in unit_price,
# one field short, one field extra, blank quantity, spaces-only category,
# quoted comma in city, unit_price too wide for its type, quantity with a decimal.
CSV_QTY_TOKEN, CSV_PRICE_TOKEN, CSV_SHORT, CSV_LONG = 211, 223, 227, 229
CSV_BLANK_QTY, CSV_SPACES_CATEGORY, CSV_QUOTED_CITY = 233, 239, 241
CSV_WIDE_PRICE, CSV_DECIMAL_QTY = 251, 257
WIDE_PRICE, DECIMAL_QTY = "1234567890.25", "2.5"
SPACES_CATEGORY = "   "
QUOTED_CITY = "Navi Mumbai, Thane"
# --- end of fixed values -------------------------------------------------------

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Columns the view needs from each driver table, with their stored types.
# Reading with an explicit schema skips footer-based inference and reads only
# these columns.
VIEW_INPUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_type string",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"),
}


def table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order, customer, nation, region and part.

    Join order keeps the widest table (lineitem) to two shuffles of narrow rows:
    lineitem joins part on the part key before it has the order's texts, orders is
    enriched with its customer's geography (orders is ~1/4 of lineitem), and
    the two meet on the order key.

    lineitem x orders is hinted as a sort-merge join: both are fact-sized, and
    without column statistics the planner's size estimate for a join is the
    product of its inputs, which makes the raw lineitem scan look like the
    smaller side and gets it broadcast (one task builds a hash table of the
    whole fact table). The hint keeps both sides hash-partitioned on the order
    key instead. Dimension joins are left to the planner: a side is broadcast
    only when its scan statistics are under
    ``spark.sql.autoBroadcastJoinThreshold`` (nation/region always, customer
    and part at small scale), otherwise sort-merge; AQE splits skewed partitions.
    """
    t = {name: table(spark, sf_dir, name, ddl) for name, ddl in VIEW_INPUTS.items()}
    geo = t["nation"].join(t["region"], F.expr("n_regionkey = r_regionkey")).select("n_nationkey", "n_name", "r_name")
    # nation x region has 25 rows at every scale factor (fixed by the TPC-H
    # schema), so broadcasting it is bounded; the planner's size-product
    # estimate would otherwise broadcast customer, which grows with the data.
    customer = t["customer"].join(F.broadcast(geo), F.expr("c_nationkey = n_nationkey"))
    orders = t["orders"].join(customer, F.expr("o_custkey = c_custkey"))
    # dates without their time, which nothing reads, are shorter to shuffle
    lineitem = t["lineitem"].withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return (lineitem
            .join(t["part"], F.expr("l_partkey = p_partkey"))
            .join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey")))


def _lit(v: str) -> str:
    assert "'" not in v and "\\" not in v, v
    return f"'{v}'"


def padded(key: str, width: int) -> str:
    """The key with zeros in front, at least ``width`` long; longer keys stay whole
    (``lpad`` alone would cut them)."""
    text = f"CAST({key} AS STRING)"
    return f"lpad({text}, greatest({width}, length({text})), '0')"


def _raw_exprs() -> list[str]:
    """The 13 raw columns as SQL expressions over the joined row (one JVM parse
    each instead of hundreds of Column-building calls)."""
    cat = ("CASE " + " ".join(f"WHEN l_partkey % 13 = {k} THEN {_lit(v)}" for k, v in PART_KEY_CATEGORY.items())
           + " " + " ".join(f"WHEN p_type = {_lit(k)} THEN {_lit(v)}" for k, v in PART_TYPE_CATEGORY.items())
           + f" ELSE {_lit(OTHER_CATEGORY)} END")
    city = " ".join(f"WHEN o_custkey % 20 = {k} THEN {_lit(v)}" for k, v in CITY_VARIANTS.items())
    bad_dates = " ".join(f"WHEN l_orderkey % {m} = 0 THEN {_lit(v)}" for m, v in BAD_ORDER_DATES)
    qty = "CAST(l_quantity AS INT)"
    price = f"CAST(l_extendedprice AS {PRICE.simpleString()})"
    disc = f"CAST(l_discount AS {RATE.simpleString()})"
    amount = TOTAL.simpleString()
    return [
        f"concat('TXN', {padded('l_orderkey', 9)}, '-', CAST(l_linenumber AS STRING)) AS transaction_id",
        f"CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE concat('CUST', {padded('o_custkey', 7)}) END"
        " AS customer_id",
        f"concat('PROD', {padded('l_partkey', 7)}) AS product_id",
        f"CASE WHEN l_orderkey % 67 = 0 THEN NULL WHEN l_orderkey % 31 = 0 THEN lower({cat})"
        f" WHEN l_orderkey % 37 = 0 THEN concat('  ', upper({cat}), ' ') ELSE {cat} END AS category",
        f"CASE WHEN o_custkey % 71 = 0 THEN NULL {city} ELSE n_name END AS city",
        "r_name AS state",
        f"CASE WHEN l_partkey % 101 = 0 THEN -{qty} ELSE {qty} END AS quantity",
        f"{price} AS unit_price",
        f"{disc} AS discount",
        f"CASE WHEN l_orderkey % 97 = 0 THEN CAST({WRONG_TOTAL} AS {amount})"
        f" ELSE CAST(round({qty} * {price} * (1 - {disc}), 2) AS {amount}) END AS total_amount",
        "CASE WHEN l_orderkey % 59 = 0 THEN NULL ELSE o_orderpriority END AS payment_method",
        f"CASE {bad_dates} ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS order_date",
        "CASE WHEN l_orderkey % 113 = 0 THEN NULL ELSE date_format(l_shipdate, 'yyyy-MM-dd') END AS delivery_date",
    ]


def sales_raw(spark: SparkSession, sf_dir: str, keys: bool = False) -> DataFrame:
    """The 13-column raw sales view; rows with l_orderkey % 89 = 0 appear twice.

    The copies are made by exploding a 1- or 2-element array on the joined row,
    so the joins run once. ``keys=True`` keeps ``l_orderkey`` for CSV rendering.
    """
    copies = "explode(sequence(1, CASE WHEN l_orderkey % 89 = 0 THEN 2 ELSE 1 END)) AS _copy"
    exprs = _raw_exprs() + (["l_orderkey", "l_linenumber"] if keys else [])
    return sales_base(spark, sf_dir).selectExpr(*exprs, copies).drop("_copy")


def sales_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw view rendered as CSV text lines (column ``value``, no header), with
    the CSV-only faults of FIXTURES.md section 5 injected by key."""
    tokens = "array(" + ", ".join(_lit(t) for t in GARBAGE_TOKENS) + ")"
    token = f"element_at({tokens}, CAST(l_linenumber % {len(GARBAGE_TOKENS)} + 1 AS INT))"
    fields = []
    for name in RAW_COLUMNS:
        f = f"coalesce(CAST({name} AS STRING), '')"
        if name == "quantity":
            f = f"CASE WHEN l_orderkey % {CSV_QTY_TOKEN} = 0 THEN {token} WHEN l_orderkey % {CSV_BLANK_QTY} = 0 THEN ''"
            f += f" WHEN l_orderkey % {CSV_DECIMAL_QTY} = 0 THEN {_lit(DECIMAL_QTY)} ELSE coalesce(CAST(quantity AS STRING), '') END"
        elif name == "unit_price":
            f = f"CASE WHEN l_orderkey % {CSV_PRICE_TOKEN} = 0 THEN {token} WHEN l_orderkey % {CSV_WIDE_PRICE} = 0 THEN {_lit(WIDE_PRICE)} ELSE {f} END"
        elif name == "category":
            f = f"CASE WHEN l_orderkey % {CSV_SPACES_CATEGORY} = 0 THEN {_lit(SPACES_CATEGORY)} ELSE {f} END"
        elif name == "city":
            f = f"CASE WHEN l_orderkey % {CSV_QUOTED_CITY} = 0 THEN {_lit(chr(34) + QUOTED_CITY + chr(34))} ELSE {f} END"
        fields.append(f)
    line = "concat_ws(',', " + ", ".join(fields) + ")"
    value = (f"CASE WHEN l_orderkey % {CSV_SHORT} = 0 THEN regexp_replace(line, ',[^,]*$', '')"
             f" WHEN l_orderkey % {CSV_LONG} = 0 THEN concat(line, ',EXTRA') ELSE line END")
    # each explode makes its one-element array a column, so a line is rendered once, whoever reads it
    lines = sales_raw(spark, sf_dir, keys=True).selectExpr("l_orderkey", f"explode(array({line})) AS line")
    return lines.selectExpr(f"explode(array({value})) AS value")


def write_sales_csv(spark: SparkSession, sf_dir: str, path: str, compression: str = "none") -> str:
    """Write the rendered lines as text files (a CSV folder), a header at the top of
    each file, and return the path. A compressed file is read by one task."""
    lines = sales_csv_lines(spark, sf_dir)
    # the lower 33 bits of the id number the rows of a partition, which is written as one file
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit(",".join(RAW_COLUMNS))
    numbered = lines.select("value", first.alias("first"))
    (numbered.select(F.explode(F.when(F.col("first"), F.array(header, "value")).otherwise(F.array("value"))).alias("value"))
     .write.mode("overwrite").text(path, compression=compression))
    return path
