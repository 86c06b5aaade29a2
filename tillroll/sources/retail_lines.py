"""Transaction lines derived from the star-schema test tables.

The test data has orders, line items, parts, customers and nations, but no
retail transaction lines, no missing values and no special stock codes.  This
source maps one line item to one transaction line and injects the cases the
cleaning rules exist for (fees, bank charges, manual lines, discounts,
postage, samples, cancelled invoices, negative and zero quantities, missing
dates / prices / stock codes / descriptions, unidentified customers) from a
hash ``h`` of the line's keys.  The same mapping is written in SQL for the
DuckDB oracle (``oracle/sql.py``); the two must stay identical.

Join order is chosen for scale: ``orders`` meets ``customer`` (and the
25-row ``nation``) and the narrow line items meet ``part`` first, so the last
shuffle is by ``l_orderkey`` (sort-merge with orders): the lines come out in
the order of their invoices, and aggregates by invoice or customer combine
them before they shuffle.  Text columns are made after the joins.  Spark
(AQE) broadcasts ``part`` or ``customer`` only when their measured size is
under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schema as S
from tillroll.sources.tables import read_table

#: Tables that the lines are derived from.
TABLES = ("lineitem", "orders", "part", "customer", "nation")


def _case(h: Column, mapping: dict, default: Column) -> Column:
    expr = None
    for key, value in mapping.items():
        v = F.lit(value) if not isinstance(value, Column) else value
        expr = F.when(h == key, v) if expr is None else expr.when(h == key, v)
    return expr.otherwise(default)


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transaction lines (``schema.RAW_SCHEMA``) for one test-data directory.

    The line hash ``h`` and the order's columns are computed before the joins,
    so join inputs are narrow; invoice and stock texts after them.
    """
    li = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    # Line-item side: the hash, and the columns derived from line-item columns.
    h = (F.col("l_orderkey") * 31 + F.col("l_partkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_suppkey")) % 1000
    returned = (F.col("l_returnflag") == "R").alias("returned")
    li = li.select("l_orderkey", "l_partkey", "l_quantity", returned, h.alias("h"))
    h, returned = F.col("h"), F.col("returned")
    orderkey_text = F.col("l_orderkey").cast("string")
    invoice = F.when((h == 32) | (returned & (h % 8 == 0)), F.concat(F.lit("c"), orderkey_text)).otherwise(
        orderkey_text
    )
    stock = _case(
        h,
        {0: "AMAZONFEE", 1: "cruk", 2: "BANK CHARGES", 3: "m", 4: " D ", 5: F.lit(None).cast("string")},
        # Zero-padded to 6 digits; longer keys are kept whole (lpad alone
        # would cut them to 6 characters and merge different parts).
        F.concat(
            F.lit("P"),
            F.when(F.col("l_partkey") < 1000000, F.lpad(F.col("l_partkey").cast("string"), 6, "0")).otherwise(
                F.col("l_partkey").cast("string")
            ),
        ),
    )
    qty = (
        F.when(h == 20, F.lit(0.0))
        .when(h == 32, F.col("l_quantity"))
        .when(returned & (h % 4 == 0), -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
    ).cast("bigint")
    # Order side: customer id and country.  nation has one row per country
    # (25 in TPC-H): a fixed, tiny bound, so it is broadcast.
    od = F.col("o_orderdate")
    customer_id = F.when(
        (F.col("o_custkey") % 4 == 0) | ((F.year(od) == 1996) & (F.month(od) == 2)), F.lit(None)
    ).otherwise(F.col("o_custkey")).cast("bigint")
    cust_nation = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", F.col("n_name").alias(S.COUNTRY)
    )
    order_side = orders.join(cust_nation, orders.o_custkey == cust_nation.c_custkey).select(
        "o_orderkey", "o_orderdate", customer_id.alias(S.CUSTOMER), S.COUNTRY
    )

    # Line items and orders are the two largest tables: co-partition them by
    # order key (sort-merge) rather than collecting either side to the driver.
    lines = li.join(part, li.l_partkey == part.p_partkey)
    b = lines.hint("merge").join(order_side, F.col("l_orderkey") == order_side.o_orderkey)
    description = _case(
        h,
        {
            10: "Amazon fee",
            11: "CRUK Commission",
            12: "bank charges",
            13: "Manual",
            14: "Discount",
            15: "DOTCOM POSTAGE",
            17: "SAMPLES",
            18: F.lit(None).cast("string"),
            24: F.lit(None).cast("string"),
        },
        F.upper(F.col("p_name")),
    )
    invoice_date = F.when(h.isin(21, 28), F.lit(None)).otherwise(F.col("o_orderdate")).cast("timestamp_ntz")
    price = F.when(h == 22, F.lit(0.0)).when(h == 23, F.lit(None)).otherwise(F.col("p_retailprice")).cast("double")
    return b.select(
        invoice.alias(S.INVOICE),
        stock.alias(S.STOCK),
        description.alias(S.DESCRIPTION),
        qty.alias(S.QUANTITY),
        invoice_date.alias(S.INVOICE_DATE),
        price.alias(S.UNIT_PRICE),
        S.CUSTOMER,
        S.COUNTRY,
    )
