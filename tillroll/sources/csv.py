"""Headed transaction-line CSV reader.

Columns are found by their names in the header, wherever they stand; a file
without one of the eight is an error, and so is a folder whose files differ
in their headers.  Every column is read as text (no inference pass over the
data), the tokens pandas reads as missing become nulls, and the rest is
converted to ``schema.RAW_SCHEMA``.

A value that does not convert (a fractional quantity, an unknown date form, a
row with the wrong number of fields) stops the job by default, naming the
value.  With ``on_bad="reject"`` such lines are left out and ``rejected_lines``
counts them by column; no line is changed or dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schema as S
from tillroll.sources.csv_split import quoted_records

DEFAULT_DATE_FORMATS = (
    "M/d/yyyy H:mm[:ss]",
    "M/d/yyyy",
    "M/d/yyyy h:mm[:ss] a",
    "yyyy-M-d h:mm[:ss] a",
    "yyyy-M-d H:mm[:ss][.SSSSSS][.SSS]",
    "yyyy-M-d'T'H:mm[:ss][.SSSSSS][.SSS]",
    "yyyy-M-d",
    "yyyy/M/d[ H:mm[:ss]]",
    "yyyyMMdd",
)
#: Holds the text of a row that does not split into the header's fields.
BROKEN = "_broken_row"


def _value(name: str) -> Column:
    return F.when(~F.col(name).isin(S.CSV_NULL_TOKENS), F.col(name))


def _parse_ts(c: Column, formats) -> Column:
    """A trailing Z (UTC) is taken as it stands: times are wall-clock times."""
    c = F.regexp_replace(c, r"(?<=\d)\s*Z$", "")
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def _to_long(c: Column) -> Column:
    """Whole numbers, exact to 64 bits; ``17850.0`` (as float columns are
    written) counts as whole, ``2.5`` does not convert."""
    whole = F.regexp_replace(F.trim(c), r"\.0*$", "")
    wide = F.trim(c).try_cast("decimal(38,10)")  # forms like 1.7850E+4
    return F.coalesce(whole.try_cast("bigint"), F.when(wide == F.floor(wide), wide).try_cast("bigint"))


def _converted(date_formats) -> dict[str, Column]:
    """Expression of every raw column over its text."""
    out = {c: _value(c) for c in S.RAW_COLUMNS}
    out[S.QUANTITY] = _to_long(_value(S.QUANTITY))
    out[S.CUSTOMER] = _to_long(_value(S.CUSTOMER))
    price = F.trim(_value(S.UNIT_PRICE)).try_cast("double")
    out[S.UNIT_PRICE] = F.when(F.abs(price) != float("inf"), price)  # no amount is infinite
    out[S.INVOICE_DATE] = _parse_ts(F.trim(_value(S.INVOICE_DATE)), date_formats)
    return out


def _faults(converted: dict[str, Column]) -> Column:
    """Name of the first column whose text does not convert, or null."""
    fault = F.when(F.col(BROKEN).isNotNull(), F.lit("row"))
    for name in (S.QUANTITY, S.INVOICE_DATE, S.UNIT_PRICE, S.CUSTOMER):
        fault = fault.when(_value(name).isNotNull() & converted[name].isNull(), F.lit(name))
    return fault


def text_schema(header: list[str]) -> T.StructType:
    """All columns of the header as text, and the broken-row column."""
    missing = [c for c in S.RAW_COLUMNS if header.count(c) != 1]
    if missing:
        raise ValueError(f"CSV header needs each of these columns once: {', '.join(missing)}")
    return T.StructType([T.StructField(c, T.StringType(), True) for c in [*header, BROKEN]])


def with_options(reader, header: list[str], multiline: bool):
    """The shared reader options (batch and streaming)."""
    return (
        reader.schema(text_schema(header))
        .option("header", True)
        .option("enforceSchema", False)  # a file with another header is an error
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("columnPruning", False)  # fields are counted whatever a query reads
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
    )


def read_header(spark: SparkSession, path) -> list[str]:
    """Column names of the first file (reads one line)."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path).columns


def typed_lines(text: DataFrame, date_formats=DEFAULT_DATE_FORMATS, on_bad: str = "fail") -> DataFrame:
    """Raw text columns to ``schema.RAW_SCHEMA`` (batch and streaming)."""
    if on_bad not in ("fail", "reject"):
        raise ValueError(f"on_bad must be 'fail' or 'reject', not {on_bad!r}")
    converted = _converted(date_formats)
    fault = _faults(converted)
    if on_bad == "reject":
        kept = text.where(fault.isNull())
        return kept.select(*[converted[c].alias(c) for c in S.RAW_COLUMNS])

    # The check sits in the columns that every use of the lines reads.
    told = F.concat(F.lit("bad CSV line, column "), fault, F.lit(": "), F.to_json(F.struct(*S.RAW_COLUMNS)))

    def checked(name: str) -> Column:
        kind = S.RAW_SCHEMA[name].dataType
        return F.when(fault.isNotNull(), F.raise_error(told).cast(kind)).otherwise(converted[name])

    return text.select(*[(checked(c) if c in S.REQUIRED_COLUMNS else converted[c]).alias(c) for c in S.RAW_COLUMNS])


def read_text_lines(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """All columns of the files as text."""
    header = read_header(spark, path)
    if not multiline:
        return with_options(spark.read, header, False).csv(path)
    schema = text_schema(header)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    row = F.from_csv("record", ", ".join(f"`{c}` string" for c in schema.names), options)
    return quoted_records(spark, path, header).select(row.alias("row")).select("row.*")


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    date_formats=DEFAULT_DATE_FORMATS,
    multiline: bool = False,
    on_bad: str = "fail",
) -> DataFrame:
    """Read raw transaction lines from headed CSV files or directories.

    Files are split by line and read in parallel.  ``multiline`` allows
    newlines inside quoted fields (``csv_split``: also in parallel, with one
    more pass over the text); without it such a row counts as broken.
    """
    return typed_lines(read_text_lines(spark, path, multiline), date_formats, on_bad)


def rejected_lines(
    spark: SparkSession, path: str | list[str], date_formats=DEFAULT_DATE_FORMATS, multiline: bool = False
) -> DataFrame:
    """(column, lines): how many lines ``on_bad="reject"`` leaves out, by the
    first column that does not convert (``row``: wrong number of fields)."""
    text = read_text_lines(spark, path, multiline)
    fault = _faults(_converted(date_formats)).alias("column")
    return text.select(fault).where("column is not null").groupBy("column").agg(F.count("*").alias("lines"))
