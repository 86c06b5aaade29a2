"""Return drivers: the SKUs with the largest merchandise return burden."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import schema as S
from tillroll.functions.columns import as_double
from tillroll.operators.clean import return_lines
from tillroll.operators.ranking import top_n as limit_per_group


def return_sku_month(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Exact return value and units per (month, StockCode, Description)."""
    return return_lines(fact, month_col).groupBy(month_col, S.STOCK, S.DESCRIPTION).agg(
        F.sum("return_value").alias("_rv"),
        F.sum("abs_quantity").alias("return_units"),
    )


def top_return_skus(
    fact: DataFrame | None, month_col: str = S.MONTH, top_n: int = 10, returns: DataFrame | None = None
) -> DataFrame:
    """Per month, the ``top_n`` (StockCode, Description) groups with the largest
    |sum of return value|; a null Description is a group of its own.
    ``returns`` may be a ``return_sku_month`` frame to share.

    Ties rank by StockCode, then Description (nulls last).  The top-N cut is
    applied per map task before the shuffle (group limit).
    """
    r = returns if returns is not None else return_sku_month(fact, month_col)
    r = r.withColumn("_burden", F.abs("_rv"))
    order = [F.desc("_burden"), F.asc(S.STOCK), F.asc_nulls_last(S.DESCRIPTION)]
    best = limit_per_group(r, [month_col], order, top_n, "rank")
    return best.select(
        month_col,
        S.STOCK,
        S.DESCRIPTION,
        as_double("_burden").alias("return_burden"),
        F.col("return_units").cast("bigint").alias("return_units"),
        "rank",
    )
