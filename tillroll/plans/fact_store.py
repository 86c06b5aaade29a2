"""Cleaned fact lines and their shared aggregates, written once per session.

Every month-grain metric starts from the cleaned fact lines.  Re-running the
source joins and the cleaning for each metric (and for each branch of a
metric's plan) would repeat the most expensive part of the work, so the
cleaned lines are written as parquet to the shared checkpoint folder the
first time they are asked for, and later requests read that table back
(column-pruned, with filters pushed into the scan).  The customer-month and
month aggregates that several tables read are written beside them.

A written table is used again only while the files behind it are the same
(path, size and time of every file below the source tables), and is deleted
when the session's JVM ends.
"""

from __future__ import annotations

import hashlib
import re
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import operators as ops
from tillroll import schema as S
from tillroll.operators.clean import clean_lines
from tillroll.plans.materialize import delete_on_exit, table_path, write_and_read
from tillroll.plans.monthly_state import MonthlyState
from tillroll.sources.retail_lines import TABLES, retail_lines
from tillroll.sources.tables import table_path as source_path

_lock = threading.RLock()
_tables: dict[tuple, DataFrame] = {}
_states: dict[tuple, MonthlyState] = {}
#: Deliveries that the lines of a directory are dealt to for its state.
DELIVERIES = 2


def _listing(jvm, fs, path) -> list[str]:
    """Status (path, length, modification time) of all files below ``path``:
    two calls to the JVM for each folder, whatever the number of files."""
    entries = fs.listStatus(path)
    text = re.sub(r"access_time=[^;]*;", "", jvm.scala.runtime.ScalaRunTime.stringOf(entries))
    found = [text]
    if "isDirectory=true" in text:
        for e in entries:
            if e.isDirectory():
                found += _listing(jvm, fs, e.getPath())
    return found


def _signature(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the status of all files of the source tables."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    digest = hashlib.sha256()
    for name in TABLES:
        path = jvm.org.apache.hadoop.fs.Path(source_path(sf_dir, name))
        for text in sorted(_listing(jvm, path.getFileSystem(conf), path)):
            digest.update(text.encode("utf-8"))
    return digest.hexdigest()


def _written(spark: SparkSession, name: str, signature: str, build) -> DataFrame:
    with _lock:
        key = (spark.sparkContext.applicationId, name, signature)
        if key not in _tables:
            path = table_path(spark, name)
            _tables[key] = write_and_read(build(), name, path=path)
            delete_on_exit(spark, path)
        return _tables[key]


def _lines(spark: SparkSession, sf_dir: str, signature: str) -> DataFrame:
    return _written(spark, "fact_lines", signature, lambda: clean_lines(retail_lines(spark, sf_dir)))


def fact_lines(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """Cleaned fact lines of ``sf_dir`` (written once per session)."""
    if not materialize:
        return clean_lines(retail_lines(spark, sf_dir))
    return _lines(spark, sf_dir, _signature(spark, sf_dir))


def shared_aggregates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The customer-month and month aggregates (written once per session)."""
    signature = _signature(spark, sf_dir)
    fact = _lines(spark, sf_dir, signature)
    cust = _written(spark, "customer_month", signature, lambda: ops.customer_month_sales(fact))
    facts = _written(spark, "month_facts", signature, lambda: ops.month_facts(fact, cust=cust))
    return cust, facts


def _deal(spark: SparkSession, raw: DataFrame, path: str) -> None:
    """Raw lines as one folder per delivery, dealt by invoice.  A task keeps
    the files of all deliveries open, so it need not sort its lines by delivery
    and each file keeps them in their order."""
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    part = F.pmod(F.xxhash64(S.INVOICE), F.lit(DELIVERIES))
    spark.conf.set(writers, str(DELIVERIES))
    try:
        raw.withColumn("delivery", part).write.partitionBy("delivery").parquet(path)
    finally:
        spark.conf.set(writers, before)


def monthly_state(spark: SparkSession, sf_dir: str) -> MonthlyState:
    """The stored aggregates of all lines of ``sf_dir``, built once per
    session the way a monthly job builds them: the raw lines come in
    deliveries (dealt by invoice, so months, customers and SKUs span them),
    each is added on its own, and the first is offered a second time."""
    with _lock:
        key = (spark.sparkContext.applicationId, "state", _signature(spark, sf_dir))
        if key not in _states:
            raw_path, state_path = table_path(spark, "raw_deliveries"), table_path(spark, "monthly_state")
            _deal(spark, retail_lines(spark, sf_dir), raw_path)
            state = MonthlyState(spark, state_path)
            for k in [*range(DELIVERIES), 0]:
                state.add_files(f"{raw_path}/delivery={k}", lambda paths: spark.read.parquet(*paths))
            delete_on_exit(spark, raw_path)
            delete_on_exit(spark, state_path)
            _states[key] = state
        return _states[key]
