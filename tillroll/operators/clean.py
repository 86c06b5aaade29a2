"""Cleaning and classification of raw transaction lines into fact lines.

One narrow, map-only stage: a null/NaN drop on the required columns, a price
filter, one ``CASE`` chain for the transaction type and a handful of derived
columns.  No shuffle, no UDF; Catalyst fuses it into the scan's codegen stage
and pushes the ``UnitPrice > 0`` / ``IS NOT NULL`` filters into parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schema as S
from tillroll.functions.columns import line_money, money, norm_code


def classify_normalized(inv: Column, code: Column, desc: Column, qty: Column) -> Column:
    """Transaction type from upper-cased, stripped invoice and stock code, the
    upper-cased description ('' when missing) and the quantity.

    The first matching rule wins.  Adjustment rules (fees, bank charges,
    manual lines, discounts, postage, samples) come before the return rule, so
    a negative postage line is POSTAGE.  A line that matches nothing is
    PRODUCT (quantity 0 included).  Substring tests need no strip: no pattern
    begins or ends with white space.
    """
    expr = None
    for type_name, codes, substrings in S.CLASSIFY_RULES:
        tests = ([code.isin(codes)] if codes else []) + [desc.contains(s) for s in substrings]
        cond = tests[0]
        for t in tests[1:]:
            cond = cond | t
        expr = F.when(cond, type_name) if expr is None else expr.when(cond, type_name)
    is_return = inv.startswith(S.RETURN_INVOICE_PREFIX) | (qty < 0)
    return expr.when(F.coalesce(is_return, F.lit(False)), S.TYPE_RETURN).otherwise(S.TYPE_PRODUCT)


def classify_expr(
    invoice: Column | str = S.INVOICE,
    stock: Column | str = S.STOCK,
    description: Column | str = S.DESCRIPTION,
    quantity: Column | str = S.QUANTITY,
) -> Column:
    """Transaction type of a raw line (see ``classify_normalized``)."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return classify_normalized(
        norm_code(col(invoice)),
        norm_code(col(stock)),
        F.upper(F.coalesce(col(description), F.lit(""))),
        col(quantity),
    )


def clean_lines(raw: DataFrame, money_scale: int = S.MONEY_SCALE) -> DataFrame:
    """Raw lines -> fact lines (raw columns + type, flags, money, dates).

    Money columns are exact ``DECIMAL(38, money_scale)``: the unit price with
    ``money_scale`` decimals, multiplied by the quantity.
    """
    df = raw.na.drop(subset=S.REQUIRED_COLUMNS)  # also drops NaN prices
    df = df.withColumn(S.INVOICE_DATE, F.col(S.INVOICE_DATE).cast("timestamp_ntz"))
    df = df.filter(F.col(S.UNIT_PRICE) > 0)

    # Normalise once; the CASE chain below reads these columns many times.
    df = df.select(
        "*",
        norm_code(S.INVOICE).alias("_inv"),
        norm_code(S.STOCK).alias("_code"),
        F.upper(F.coalesce(F.col(S.DESCRIPTION), F.lit(""))).alias("_desc"),
        money(S.UNIT_PRICE, money_scale).alias("_price"),
    )
    typ = classify_normalized(F.col("_inv"), F.col("_code"), F.col("_desc"), F.col(S.QUANTITY))
    qty = F.col(S.QUANTITY)
    money_type = f"decimal(38,{money_scale})"
    line_gmv = line_money(S.UNIT_PRICE, S.QUANTITY, money_scale, F.col("_price"))
    zero = F.lit(0).cast(money_type)

    # Price and amount have projections of their own: with a copy of their
    # decimal arithmetic for every use Java does not compile the method.
    df = df.select("*", typ.alias(S.TYPE), line_gmv.alias("line_gmv"))
    line_gmv = F.col("line_gmv")
    is_return = F.col(S.TYPE) == S.TYPE_RETURN
    is_product = F.col(S.TYPE) == S.TYPE_PRODUCT
    order_date = F.to_date(F.col(S.INVOICE_DATE))
    return df.select(
        *S.RAW_COLUMNS,
        F.col(S.TYPE),
        is_return.alias("is_return"),
        is_product.alias("is_product"),
        F.col(S.TYPE).isin(S.NON_MERCH_TYPES).alias("is_non_merch_adjustment"),
        line_gmv,
        F.when(is_product & (qty > 0), line_gmv).otherwise(zero).alias("net_gmv"),
        F.when(is_return, line_gmv).otherwise(zero).alias("return_value"),
        order_date.alias(S.ORDER_DATE),
        F.trunc(order_date, "MM").alias(S.MONTH),
        F.abs(qty).alias("abs_quantity"),
    )


def product_lines(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """PRODUCT lines that fall in a month (null dates have no month)."""
    return fact.filter((F.col(S.TYPE) == S.TYPE_PRODUCT) & F.col(month_col).isNotNull())


def return_lines(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    return fact.filter((F.col(S.TYPE) == S.TYPE_RETURN) & F.col(month_col).isNotNull())


def type_mix(fact: DataFrame) -> DataFrame:
    """Line count per transaction type (a data-quality view of the rules)."""
    return fact.groupBy(S.TYPE).agg(F.count(F.lit(1)).alias("line_count"))
