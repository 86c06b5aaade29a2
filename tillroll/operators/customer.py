"""Identified-customer metrics: ID coverage, next-month retention, customer
concentration and purchase cohorts.

Customer sets are never materialised per month.  Retention and cohorts work
on the distinct (CustomerID, month) pairs, which a map-side-combined
aggregate produces; a window partitioned by customer then sees at most one
row per month per customer, however many lines a customer has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll import schema as S
from tillroll.functions.columns import as_double, check_freq, period_label, period_ordinal, period_start, safe_ratio
from tillroll.operators.clean import product_lines
from tillroll.operators.kpi import _totals_and_squares, hhi_expr, month_facts
from tillroll.operators.ranking import rank_by_value, top_by_value


def customer_months(fact: DataFrame, month_col: str = S.MONTH, cust: DataFrame | None = None) -> DataFrame:
    """Distinct (CustomerID, month) of identified PRODUCT lines.

    ``cust`` may be a ``customer_month_sales`` frame (same keys) to share."""
    if cust is not None:
        return cust.select(S.CUSTOMER, month_col)
    p = product_lines(fact, month_col).filter(F.col(S.CUSTOMER).isNotNull())
    return p.select(S.CUSTOMER, month_col).distinct()


def customer_id_coverage(fact: DataFrame, month_col: str = S.MONTH, facts: DataFrame | None = None) -> DataFrame:
    """Share of PRODUCT rows, orders and sales carrying a customer id, per month.

    Read from ``month_facts`` (one conditional aggregate; pass it in to
    share it with the KPI table); months without identified lines get zeros.
    """
    facts = facts if facts is not None else month_facts(fact, month_col)
    agg = facts.filter(F.col("_prod_rows") > 0)
    sales = as_double("_net")
    id_sales = F.coalesce(as_double("_id_net"), F.lit(0.0))
    return agg.select(
        month_col,
        F.col("_prod_rows").alias("total_product_rows"),
        F.col("_orders").alias("total_product_orders"),
        sales.alias("total_product_sales"),
        F.col("_id_rows").alias("identified_product_rows"),
        F.col("_id_orders").alias("identified_product_orders"),
        id_sales.alias("identified_product_sales"),
        safe_ratio("_id_rows", "_prod_rows").alias("identified_row_coverage"),
        safe_ratio("_id_orders", "_orders").alias("identified_order_coverage"),
        safe_ratio(id_sales, sales).alias("identified_sales_coverage"),
    )


def _retention_from_calendar(cm: DataFrame, calendar: DataFrame, month_col: str) -> DataFrame:
    # calendar: one row per month; pair each month with the next observed one.
    cal = calendar.select(month_col, F.lead(month_col).over(Window.orderBy(month_col)).alias("_next"))
    # Each customer's next active month; a repeat iff it is the calendar's next.
    cust_next = F.lead(month_col).over(Window.partitionBy(S.CUSTOMER).orderBy(month_col))
    cm = cm.select(S.CUSTOMER, month_col, cust_next.alias("_cust_next"))
    counted = (
        cm.join(F.broadcast(cal), month_col)  # calendar: one row per month
        .groupBy(month_col)
        .agg(
            F.count(F.lit(1)).alias("_base"),
            F.count(F.when(F.col("_cust_next") == F.col("_next"), F.lit(1))).alias("_repeat"),
        )
    )
    out = cal.filter(F.col("_next").isNotNull()).join(F.broadcast(counted), month_col, "left")
    base = F.coalesce(F.col("_base"), F.lit(0)).cast("bigint")
    rep = F.coalesce(F.col("_repeat"), F.lit(0)).cast("bigint")
    return out.select(
        month_col,
        base.alias("current_customers"),
        rep.alias("repeat_customers"),
        safe_ratio(rep, base).alias("next_month_repeat_rate"),
    )


def retention(
    fact: DataFrame, month_col: str = S.MONTH, cust: DataFrame | None = None, facts: DataFrame | None = None
) -> DataFrame:
    """Next-month retention per observed PRODUCT month except the last.

    The next month is the next month that has PRODUCT lines (identified or
    not), not the calendar month after.  A month without identified customers
    stays, with 0 / 0 / 0.0.
    """
    if facts is not None:
        calendar = facts.filter(F.col("_prod_rows") > 0).select(month_col)
    else:
        calendar = product_lines(fact, month_col).select(month_col).distinct()
    return _retention_from_calendar(customer_months(fact, month_col, cust), calendar, month_col)


def retention_identified_calendar(fact: DataFrame, month_col: str = S.MONTH, cust: DataFrame | None = None) -> DataFrame:
    """Variant whose month sequence has only months with identified customers,
    so a wholly unidentified month is skipped and its neighbours are paired."""
    cm = customer_months(fact, month_col, cust)
    calendar = cm.select(month_col).distinct()
    return _retention_from_calendar(cm, calendar, month_col)


def customer_month_sales(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Exact PRODUCT sales per (CustomerID, month), identified lines only."""
    p = product_lines(fact, month_col).filter(F.col(S.CUSTOMER).isNotNull())
    return p.groupBy(S.CUSTOMER, month_col).agg(F.sum("net_gmv").alias("cust_gmv"))


def customer_month_rank(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Every identified customer of every month with its sales rank (ties by id)."""
    ranked = rank_by_value(customer_month_sales(fact, month_col), [month_col], "cust_gmv", S.CUSTOMER)
    return ranked.select(month_col, S.CUSTOMER, as_double("cust_gmv").alias("cust_gmv"), "rank")


def customer_concentration(
    fact: DataFrame, month_col: str = S.MONTH, n: int = 50, cust: DataFrame | None = None
) -> DataFrame:
    """``top{n}_share`` of identified sales and customer HHI, per month that
    has identified customers."""
    cr = cust if cust is not None else customer_month_sales(fact, month_col)
    totals = _totals_and_squares(cr, month_col, "cust_gmv")
    best = top_by_value(cr, [month_col], "cust_gmv", S.CUSTOMER, n, "_rank")
    tops = best.groupBy(month_col).agg(F.sum("cust_gmv").alias("_top"))
    joined = totals.join(tops, month_col, "left")
    return joined.select(
        month_col,
        safe_ratio(F.coalesce(as_double("_top"), F.lit(0.0)), as_double("_total")).alias(f"top{n}_share"),
        hhi_expr("_sq", "_total").alias("customer_hhi"),
    )


def cohort_table(
    fact: DataFrame, month_col: str = S.MONTH, freq: str = "M", cust: DataFrame | None = None
) -> DataFrame:
    """Distinct customers by first-purchase period and periods since then.

    ``freq`` is M, Q or Y; labels look like ``2010-12``, ``2010Q4``, ``2010``.
    """
    check_freq(freq)
    cm = customer_months(fact, month_col, cust)
    periods = cm.select(S.CUSTOMER, period_start(month_col, freq).alias("_period"))
    if freq != "M":
        periods = periods.distinct()
    first = F.min("_period").over(Window.partitionBy(S.CUSTOMER))
    periods = periods.select("_period", first.alias("_cohort"))
    index = (period_ordinal("_period", freq) - period_ordinal("_cohort", freq)).cast("int")
    counted = periods.groupBy("_cohort", index.alias("cohort_index")).agg(F.count(F.lit(1)).alias("customer_count"))
    return counted.select(
        period_label("_cohort", freq).alias("cohort_month"),
        "cohort_index",
        "customer_count",
    )
