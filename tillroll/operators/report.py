"""Month-grain outputs for dashboards and the monthly report: the customer
health table, the month dimension and the current-state selections (latest
full month, latest stable retention, partial-month notice, return watchlist,
snapshot row, chart series).

All inputs here have one row per month (or per month and top-N item), so
the unpartitioned ``ORDER BY month`` windows below run over a few hundred
rows at most; joins between these frames are broadcast by the month-count
bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll import schema as S
from tillroll.functions.columns import fmt_decimal, fmt_money, fmt_pct
from tillroll.operators.ranking import top_n


def customer_health_monthly(coverage: DataFrame, repeat: DataFrame, conc: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """coverage LEFT JOIN retention LEFT JOIN concentration on month.

    The last month has no retention row, so its retention columns are null.
    """
    return coverage.join(F.broadcast(repeat), month_col, "left").join(F.broadcast(conc), month_col, "left")


def dim_month(kpi: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Month dimension: partial flag, first day, year, month number, label."""
    m = F.col(month_col)
    return kpi.select(
        m,
        "is_partial_month",
        m.alias("month_start"),
        F.year(m).alias("year"),
        F.month(m).alias("month_num"),
        F.date_format(m, "yyyy-MM").alias("year_month_label"),
    )


def latest_full_month(kpi: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """The KPI row of the latest month that is not partial (empty if none)."""
    return kpi.filter(~F.col("is_partial_month")).orderBy(F.desc(month_col)).limit(1)


def stable_months(kpi: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """KPI months whose next KPI month is complete (their retention is final)."""
    nxt = F.lead("is_partial_month").over(Window.orderBy(month_col))
    return kpi.select(month_col, nxt.alias("_next_partial")).filter(~F.col("_next_partial")).select(month_col)


def latest_stable_retention(health: DataFrame, kpi: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Health row of the latest stable month (empty if none)."""
    stable = stable_months(kpi, month_col)
    return health.join(F.broadcast(stable), month_col, "left_semi").orderBy(F.desc(month_col)).limit(1)


def partial_month_notice(kpi: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """The latest partial month, if any (zero or one row)."""
    return (
        kpi.filter(F.col("is_partial_month"))
        .orderBy(F.desc(month_col))
        .limit(1)
        .select(F.col(month_col).alias("partial_month"))
    )


def report_snapshot(
    kpi: DataFrame, health: DataFrame, month_col: str = S.MONTH, top_share_col: str = "top10_share"
) -> DataFrame:
    """One row: the latest full month's headline values and their report text.

    Sales, return rate, top-50 coverage and SKU HHI come from the KPI row;
    identified sales coverage, top customer share and customer HHI from the
    health row of the same month; retention from the latest stable month.
    Missing values read ``NA``.  No full month gives no row.
    """
    h = health.select(
        month_col, "identified_sales_coverage", "next_month_repeat_rate", top_share_col, "customer_hhi"
    )
    j = kpi.join(F.broadcast(h.withColumn("_in_health", F.lit(True))), month_col, "left")
    by_month = Window.orderBy(month_col)
    whole = Window.partitionBy()
    stable = F.coalesce(~F.lead("is_partial_month").over(by_month), F.lit(False))
    j = j.withColumn("_stable", stable)
    stable_month = F.when(F.col("_stable") & F.col("_in_health"), F.col(month_col))
    j = j.select(
        "*",
        F.max(F.when(~F.col("is_partial_month"), F.col(month_col))).over(whole).alias("_latest_full"),
        F.max(stable_month).over(whole).alias("retention_month"),
        F.max_by(F.col("next_month_repeat_rate"), stable_month).over(whole).alias("_stable_rate"),
    )
    row = j.filter(F.col(month_col) == F.col("_latest_full"))
    sales = F.coalesce(F.col("product_sales_before_returns"), F.col("net_gmv"))
    rv_abs = F.abs(F.col("return_value"))
    return row.select(
        month_col,
        sales.alias("product_sales_before_returns"),
        "return_rate",
        "top50_coverage",
        "hhi",
        "identified_sales_coverage",
        "retention_month",
        F.col("_stable_rate").alias("next_month_repeat_rate"),
        top_share_col,
        "customer_hhi",
        rv_abs.alias("return_value_abs"),
        "return_unit",
        fmt_money(sales).alias("sales_text"),
        fmt_pct("return_rate").alias("return_rate_text"),
        fmt_pct("top50_coverage").alias("top50_coverage_text"),
        fmt_decimal("hhi", 4).alias("hhi_text"),
        fmt_pct("identified_sales_coverage").alias("identified_sales_coverage_text"),
        fmt_pct("_stable_rate").alias("retention_text"),
        fmt_pct(top_share_col).alias(f"{top_share_col}_text"),
        fmt_decimal("customer_hhi", 4).alias("customer_hhi_text"),
        fmt_money(rv_abs).alias("return_value_text"),
        fmt_money("return_unit").alias("return_unit_text"),
    )


def return_watchlist(top_returns: DataFrame, kpi: DataFrame, month_col: str = S.MONTH, k: int = 5) -> DataFrame:
    """The ``k`` largest return SKUs of the latest full month (burden desc,
    rank asc), with the burden as report text."""
    latest = latest_full_month(kpi, month_col).select(month_col)
    rows = top_returns.join(F.broadcast(latest), month_col, "left_semi")
    best = top_n(rows, [month_col], [F.desc("return_burden"), F.asc("rank")], k, "_w")
    return best.select(
        month_col, S.STOCK, S.DESCRIPTION, "return_burden", "return_units", "rank",
        fmt_money("return_burden").alias("return_burden_text"),
    )


KPI_SERIES = ["product_sales_before_returns", "return_rate", "top50_coverage", "hhi"]


def kpi_series_long(kpi: DataFrame, health: DataFrame, repeat: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """(series, month, value) rows feeding the trend charts."""

    def long(df, cols):
        return df.select(month_col, *[F.col(c).cast("double") for c in cols]).unpivot(
            [month_col], cols, "series", "value"
        )

    out = (
        long(kpi, KPI_SERIES)
        .unionByName(long(health, ["identified_sales_coverage"]))
        .unionByName(long(repeat, ["next_month_repeat_rate"]))
    )
    return out.select("series", month_col, "value")
