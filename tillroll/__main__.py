"""Run the monthly monitoring job.

    python -m tillroll --csv data/transactions.csv --out out/tables
    python -m tillroll --tables /root/testdata/sf0.1 --out /tmp/out --out-format csv
    python -m tillroll --csv data/incoming --state data/state --out out/tables

Reads raw transaction lines (a headed CSV file/folder, a parquet folder with
the raw schema, or the star-schema test tables), writes the nine monthly
tables and the report frames under ``--out``.  With ``--state`` only files
that the state folder does not hold yet are read, and the tables come from its
stored aggregates.  Uses the session's master and
``spark.checkpoint.dir`` when run with spark-submit.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tillroll import schema as S
from tillroll.plans.monthly_state import MonthlyState
from tillroll.plans.pipeline import publish_tables, run_pipeline
from tillroll.session import configure, input_bytes, size_shuffles
from tillroll.sources.csv import load_csv, rejected_lines
from tillroll.sources.retail_lines import retail_lines


def _incremental(spark, args) -> dict:
    """Add what is new to the state and publish the tables from it."""
    if args.csv:
        kw = {"date_formats": tuple(args.date_format)} if args.date_format else {}
        folder = args.csv

        def reader(paths):
            return load_csv(spark, paths, multiline=args.csv_multiline, on_bad=args.csv_on_bad, **kw)
    else:
        folder = args.parquet

        def reader(paths):
            return spark.read.parquet(*paths)

    state = MonthlyState(spark, args.state, args.money_scale)
    added = state.add_files(folder, reader)
    tables = state.tables(args.cohort_freq, concentration_n=args.concentration_n, top_returns_n=args.top_returns)
    version = publish_tables(spark, tables, args.out, args.out_format)
    return {"out": args.out, "files_added": added, "state_version": state.version, "published": version}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tillroll")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="headed transaction-line CSV file or folder")
    src.add_argument("--parquet", help="parquet folder with the raw line schema")
    src.add_argument("--tables", help="folder with the star-schema test tables")
    ap.add_argument("--out", required=True)
    ap.add_argument("--out-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--date-format", action="append", help="InvoiceDate pattern(s) for CSV input")
    ap.add_argument("--csv-multiline", action="store_true", help="quoted CSV fields may hold newlines")
    ap.add_argument("--csv-on-bad", default="fail", choices=["fail", "reject"], help="lines that do not convert")
    ap.add_argument("--concentration-n", type=int, default=10)
    ap.add_argument("--money-scale", type=int, default=S.MONEY_SCALE, help="decimals of unit prices")
    ap.add_argument("--top-returns", type=int, default=10)
    ap.add_argument("--cohort-freq", default="M", choices=["M", "Q", "Y"])
    ap.add_argument("--state", help="folder of stored aggregates: read new files only (--csv or --parquet folders)")
    ap.add_argument("--versioned", action="store_true", help="publish all tables together under a manifest")
    args = ap.parse_args(argv)
    if args.state and args.tables:
        ap.error("--state reads files: use it with --csv or --parquet")

    spark = SparkSession.builder.appName("tillroll").getOrCreate()
    configure(spark)
    sc = spark.sparkContext
    if sc.master.startswith("local") and not sc.getConf().contains("spark.sql.shuffle.partitions"):
        # Local run without an explicit setting: start from the core count
        # (size_shuffles below still raises it for large inputs).
        spark.conf.set("spark.sql.shuffle.partitions", str(2 * sc.defaultParallelism))
    if args.state:
        print(_incremental(spark, args))
        return
    if args.csv:
        kw = {"date_formats": tuple(args.date_format)} if args.date_format else {}
        kw["multiline"] = args.csv_multiline
        raw = load_csv(spark, args.csv, on_bad=args.csv_on_bad, **kw)
        if args.csv_on_bad == "reject":
            print({"rejected": {r["column"]: r["lines"] for r in rejected_lines(spark, args.csv, **kw).collect()}})
    elif args.parquet:
        raw = spark.read.parquet(args.parquet)
    else:
        raw = retail_lines(spark, args.tables)
    partitions = size_shuffles(spark, input_bytes(raw))
    timings: dict = {"shuffle_partitions": partitions}
    run_pipeline(
        raw,
        out_dir=args.out,
        # Raw parquet is cheap to re-read and cleaning is map-only, so the
        # cleaned lines are written first only for CSV or joined sources.
        materialize=not args.parquet,
        fmt=args.out_format,
        timings=timings,
        money_scale=args.money_scale,
        read_back=False,
        versioned=args.versioned,
        concentration_n=args.concentration_n,
        top_returns_n=args.top_returns,
        cohort_freq=args.cohort_freq,
    )
    print({"out": args.out, "seconds": timings})


if __name__ == "__main__":
    main()
