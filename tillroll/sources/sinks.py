"""Table writers and readers.

Month-grain tables are small (one row per month, or per month and top-N
item): each is one sorted file, with its month as ``yyyy-MM`` text.
``save_table`` writes any table, partitioned on request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import as_bool

#: Columns that hold a month; dates in tables, ``yyyy-MM`` text in files.
MONTH_COLUMNS = ("month", "retention_month", "partial_month")
#: Types of the published columns that are not double.  Shares,
#: coverages, values and rates are double; ``*_text`` and names are text.
WHOLE_COLUMNS = (
    "order customer unit_sold active_order_days return_unit calendar_days_in_month total_product_rows "
    "total_product_orders identified_product_rows identified_product_orders current_customers repeat_customers "
    "cohort_index customer_count return_units rank year month_num"
).split()
TEXT_COLUMNS = "StockCode Description cohort_month year_month_label series".split()
#: Columns whose whole numbers are INT in the tables.
INT_COLUMNS = "calendar_days_in_month cohort_index year month_num".split()


def month_text(df: DataFrame) -> DataFrame:
    """Month columns as ``yyyy-MM`` text."""
    dates = [f.name for f in df.schema if f.name in MONTH_COLUMNS and isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.date_format(c, "yyyy-MM") for c in dates})


def save_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, sort_by=None, single_file: bool = False
) -> None:
    """Overwrite ``path`` with ``df`` (parquet by default, or headed CSV).

    ``sort_by`` orders the rows: a global sort, or with ``single_file`` one
    sorted file -- only for outputs whose size is bounded independently of the
    data (the month-grain tables: months x top-N rows).  The rows move to one
    task at the end; what computes them keeps its tasks.
    """
    if single_file:
        df = df.repartition(1)
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
    elif sort_by:
        df = df.orderBy(*sort_by)
    writer = month_text(df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def _typed(name: str) -> Column:
    """A published column from its text."""
    c = F.col(name)
    if name in MONTH_COLUMNS or name == "month_start":
        return F.to_date(F.concat(F.substring(c.cast("string"), 1, 7), F.lit("-01")))
    if name == "is_partial_month":
        return as_bool(name)
    if name in WHOLE_COLUMNS:  # float columns write 884.0
        whole = F.coalesce(c.try_cast("bigint"), c.cast("double").cast("bigint"))
        return whole.cast("int") if name in INT_COLUMNS else whole
    if name in TEXT_COLUMNS or name.endswith("_text"):
        return c
    return c.cast("double")


def read_table_back(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a published table (written by ``save_table``, or a CSV of the same
    columns) with the types of the registered tables."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        months = [f.name for f in df.schema if f.name in MONTH_COLUMNS and isinstance(f.dataType, T.StringType)]
        return df.withColumns({c: _typed(c) for c in months})
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(*[_typed(c).alias(c) for c in df.columns])
