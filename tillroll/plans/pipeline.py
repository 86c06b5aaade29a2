"""The monthly monitoring job: raw lines -> fact lines -> nine month-grain
tables -> report frames -> sinks.

The pipeline reads the fact lines four times (month aggregate, SKU-month
aggregate, customer-month aggregate, return-SKU aggregate); every published
table is derived from those.  The fact lines are written once to the shared checkpoint folder and read
back, so every month-grain aggregate starts from a column-pruned parquet
scan instead of re-running the source joins, and a lost executor costs a
re-read rather than a recomputation of the lineage.  The month-grain tables
and the customer-month aggregate are cached because several tables read
them; on a lost executor the cache is rebuilt from the written fact lines.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import operators as ops
from tillroll import schema as S
from tillroll.operators.clean import clean_lines
from tillroll.plans.manifest import Manifests
from tillroll.plans.materialize import drop_path, table_path, write_and_read
from tillroll.sources.sinks import read_table_back, save_table

PUBLISHED = [
    "kpi_monthly",
    "kpi_monthly_with_mom",
    "customer_id_coverage",
    "customer_repeat_rate",
    "customer_concentration",
    "cohort_table",
    "top_return_skus",
    "customer_health_monthly",
    "dim_month",
]
REPORT = [
    "latest_full_month",
    "latest_stable_retention",
    "report_snapshot",
    "partial_month_notice",
    "return_watchlist",
    "kpi_series_long",
]


def shared_aggregates(fact: DataFrame, cache: bool = True) -> tuple[DataFrame, DataFrame]:
    """The customer-month and month aggregates that several tables read."""
    cust = ops.customer_month_sales(fact)
    cust = cust.cache() if cache else cust
    facts = ops.month_facts(fact, cust=cust)
    return cust, (facts.cache() if cache else facts)


def build_tables(
    fact: DataFrame | None,
    concentration_n: int = 10,
    top_returns_n: int = 10,
    cohort_freq: str = "M",
    cache_small: bool = True,
    shared: tuple[DataFrame, DataFrame] | None = None,
    sku: DataFrame | None = None,
    returns: DataFrame | None = None,
    cohorts: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All published tables and report frames from fact lines (lazy), or with
    ``fact`` None from their aggregates alone: ``shared`` (customer-month and
    month), ``sku`` (SKU-month), ``returns`` (return-SKU-month) and, if there
    is one, a kept ``cohorts`` table.

    Keys starting with ``_`` are the shared intermediates (cached), not
    outputs."""

    def small(df: DataFrame) -> DataFrame:
        return df.cache() if cache_small else df

    # Shared intermediates: one month aggregate and one customer-month
    # aggregate feed several tables each.
    cust, facts = shared if shared is not None else shared_aggregates(fact, cache=cache_small)
    kpi = small(ops.monthly_kpis(fact, facts=facts, sku=sku))
    coverage = small(ops.customer_id_coverage(fact, facts=facts))
    repeat = small(ops.retention(fact, cust=cust, facts=facts))
    conc = small(ops.customer_concentration(fact, n=concentration_n, cust=cust))
    top_returns = small(ops.top_return_skus(fact, top_n=top_returns_n, returns=returns))
    health = small(ops.customer_health_monthly(coverage, repeat, conc))
    tables = {
        "_customer_month": cust,
        "_month_facts": facts,
        "kpi_monthly": kpi,
        "kpi_monthly_with_mom": ops.mom_variance(kpi),
        "customer_id_coverage": coverage,
        "customer_repeat_rate": repeat,
        "customer_concentration": conc,
        "cohort_table": cohorts if cohorts is not None else ops.cohort_table(fact, freq=cohort_freq, cust=cust),
        "top_return_skus": top_returns,
        "customer_health_monthly": health,
        "dim_month": ops.dim_month(kpi),
        "latest_full_month": ops.latest_full_month(kpi),
        "latest_stable_retention": ops.latest_stable_retention(health, kpi),
        "report_snapshot": ops.report_snapshot(kpi, health, top_share_col=f"top{concentration_n}_share"),
        "partial_month_notice": ops.partial_month_notice(kpi),
        "return_watchlist": ops.return_watchlist(top_returns, kpi),
        "kpi_series_long": ops.kpi_series_long(kpi, health, repeat),
    }
    return tables


def sort_keys(name: str) -> list:
    """Row order of a written table."""
    if name == "return_watchlist":  # the order of the bar chart
        return [F.asc("return_burden"), F.desc("rank")]
    keys = {
        "cohort_table": ["cohort_month", "cohort_index"],
        "partial_month_notice": ["partial_month"],
        "top_return_skus": ["month", "rank"],
        "kpi_series_long": ["series", "month"],
    }
    return keys.get(name, ["month"])


def run_pipeline(
    raw: DataFrame,
    out_dir: str | None = None,
    fmt: str = "parquet",
    materialize: bool = True,
    parallel_jobs: int = 4,
    timings: dict | None = None,
    money_scale: int = S.MONEY_SCALE,
    read_back: bool = True,
    versioned: bool = False,
    **table_args,
) -> dict[str, DataFrame]:
    """Clean ``raw``, build every table, and (with ``out_dir``) write each to
    ``out_dir/<name>`` sorted by month.  Returns the table DataFrames: read
    back from ``out_dir`` (nothing with ``read_back=False``), or without
    ``out_dir`` the lazy tables over the written fact lines.  With
    ``versioned`` the tables go to a folder of their own and become visible
    together (``read_published``); a stopped run leaves the last set as it was.

    Independent month-grain jobs are submitted from ``parallel_jobs`` threads
    so small jobs share the cluster instead of running one after another;
    the shared caches fill while the remaining plans are being built.  Caches
    and the intermediate fact lines go in the end, also after an error.
    """
    clock = _Clock(timings)
    spark = raw.sparkSession
    fact = clean_lines(raw, money_scale)
    fact_path = table_path(spark, "fact_lines") if materialize else None
    tables: dict[str, DataFrame] = {}
    pool = ThreadPoolExecutor(max_workers=max(2, parallel_jobs))
    try:
        if fact_path:
            fact = write_and_read(fact, "fact_lines", path=fact_path)
        clock.lap("fact_lines")
        if not out_dir:
            lazy = build_tables(fact, cache_small=False, **table_args)
            fact_path = None  # the caller's tables read it
            return {n: df for n, df in lazy.items() if not n.startswith("_")}
        # Fill the shared caches on a worker while this thread builds the
        # other plans (driver-side work that needs no cluster).
        shared = shared_aggregates(fact)
        tables = {"_customer_month": shared[0], "_month_facts": shared[1]}
        filled = pool.submit(lambda: [df.count() for df in shared])
        tables = build_tables(fact, shared=shared, **table_args)
        clock.lap("plan")
        filled.result()
        clock.lap("shared_aggregates")
        outputs = {n: df for n, df in tables.items() if not n.startswith("_")}
        staged = Staged(spark, out_dir) if versioned else None
        target = f"{out_dir}/{staged.name}" if versioned else out_dir
        # The tables that the report frames read (cached) go first.
        first = ["kpi_monthly", "customer_id_coverage", "customer_repeat_rate", "customer_concentration",
                 "top_return_skus", "cohort_table"]

        def write(name):
            # Month-grain outputs (rows bounded by months x top-N): one sorted file.
            save_table(outputs[name], f"{target}/{name}", fmt, sort_by=sort_keys(name),
                       single_file=True)

        list(pool.map(write, first))
        clock.lap("base_tables")
        list(pool.map(write, [n for n in outputs if n not in first]))
        if versioned:
            staged.publish(list(outputs), fmt)
        clock.lap("derived_tables")
        return {n: read_table_back(spark, f"{target}/{n}", fmt) for n in outputs} if read_back else {}
    finally:
        pool.shutdown(wait=True, cancel_futures=True)
        for df in tables.values():
            df.unpersist()
        if fact_path:
            drop_path(spark, fact_path)
        clock.lap("read_back_and_release")


class Staged:
    """A folder for a set of tables that readers see once it is published."""

    def __init__(self, spark, out_dir: str):
        self.manifests = Manifests(spark, out_dir)
        self.version, _ = self.manifests.latest()
        self.name = f"set-{uuid.uuid4().hex}"

    def publish(self, tables: list[str], fmt: str) -> int:
        return self.manifests.commit(self.version, {"set": self.name, "tables": tables, "format": fmt})


def publish_tables(spark, tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> int:
    """Write the tables (without intermediates, ``_``) as one set and publish
    it; returns its version."""
    staged = Staged(spark, out_dir)
    outputs = {n: df for n, df in tables.items() if not n.startswith("_")}
    try:
        for name, df in outputs.items():
            path = f"{out_dir}/{staged.name}/{name}"
            save_table(df, path, fmt, sort_by=sort_keys(name), single_file=True)
        return staged.publish(list(outputs), fmt)
    except BaseException:
        staged.manifests.drop(staged.name)
        raise


def read_published(spark, out_dir: str) -> dict[str, DataFrame]:
    """The tables of the newest published set, all of one run."""
    version, content = Manifests(spark, out_dir).latest()
    if not version:
        raise ValueError(f"nothing was published in {out_dir}")
    return {
        n: read_table_back(spark, f"{out_dir.rstrip('/')}/{content['set']}/{n}", content["format"])
        for n in content["tables"]
    }


def drop_old_sets(spark, out_dir: str) -> list[str]:
    """Delete the sets that the newest manifest does not name (call it when no
    reader uses an older one and no writer runs)."""
    manifests = Manifests(spark, out_dir)
    _, content = manifests.latest()
    gone = [n for n in manifests.names() if n.startswith("set-") and n != content.get("set")]
    for name in gone:
        manifests.drop(name)
    return gone


def register_views(spark, tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Expose tables (e.g. ``run_pipeline`` output) as temp views for
    ``spark.sql``; returns the view names.  Intermediates (``_``) are skipped."""
    names = []
    for name, df in tables.items():
        if not name.startswith("_"):
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
    return names


class _Clock:
    def __init__(self, out: dict | None):
        self.out, self.t = out, time.perf_counter()

    def lap(self, name: str) -> None:
        now = time.perf_counter()
        if self.out is not None:
            self.out[name] = round(now - self.t, 3)
        self.t = now
