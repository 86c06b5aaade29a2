"""Continuous ingestion of raw transaction lines into the fact table.

The monthly tables are batch computations over the fact lines; what can run
continuously is getting new lines into that table.  ``stream_fact_lines``
watches a folder where raw files land (CSV with the raw header, or parquet
with ``schema.RAW_SCHEMA``), cleans each micro-batch with the same
``clean_lines`` expressions the batch path uses, and appends the result as
parquet partitioned by month.  The query's checkpoint makes the file sink
exactly-once across restarts and executor loss.  The batch operators (or
``run_pipeline(..., materialize=False)``) then read the sink folder.

Cleaning is row-local (no aggregation, no state), so no watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll import schema as S
from tillroll.operators.clean import clean_lines
from tillroll.sources.csv import read_header, typed_lines, with_options


def read_raw_stream(
    spark: SparkSession,
    source_dir: str,
    fmt: str = "csv",
    max_files_per_trigger: int = 100,
    header: list[str] | None = None,
    multiline: bool = False,
    on_bad: str = "fail",
) -> DataFrame:
    """Streaming DataFrame of raw lines arriving in ``source_dir``.

    CSV files are read as ``sources.csv`` reads them; ``header`` names their
    columns (by default those of the first file there, so one must exist)."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "parquet":
        return reader.schema(S.RAW_SCHEMA).parquet(source_dir)
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    header = read_header(spark, source_dir) if header is None else header
    return typed_lines(with_options(reader, header, multiline).csv(source_dir), on_bad=on_bad)


def stream_fact_lines(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    checkpoint_location: str,
    fmt: str = "csv",
    trigger_available_now: bool = False,
    processing_time: str = "1 minute",
    **read_args,
) -> StreamingQuery:
    """Start the ingestion query: raw files -> cleaned fact lines (parquet,
    partitioned by month, appended).  ``checkpoint_location`` must be on
    shared storage on a cluster; ``read_args`` go to ``read_raw_stream``."""
    facts = clean_lines(read_raw_stream(spark, source_dir, fmt, **read_args))
    writer = (
        facts.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_location)
        .partitionBy(S.MONTH)
    )
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer.trigger(
        processingTime=processing_time
    )
    return writer.start(sink_dir)
