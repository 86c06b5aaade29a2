"""Month-grain sales KPIs: totals, returns, top-N SKU coverage, SKU HHI,
the partial-month flag and month-over-month change.

Every operator takes fact lines (``clean_lines`` output) and a month column,
and returns a lazy DataFrame with one row per month.  Grouping by month runs
as a two-phase hash aggregate (map-side partial sums), so a month holding a
large share of all lines is combined before the shuffle.  Money is summed as
exact decimals and converted to double only for output and ratios.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll import schema as S
from tillroll.functions.columns import as_double, change_or_null, days_in_month, money, money_scale, pct_change, safe_ratio
from tillroll.operators.clean import product_lines, return_lines
from tillroll.operators.ranking import rank_by_value, top_by_value

KPI_COLUMNS = [
    "month", "net_gmv", "order", "customer", "unit_sold", "avg_unit_price", "active_order_days",
    "return_value", "return_unit", "return_rate", "top20_coverage", "top50_coverage", "hhi",
    "calendar_days_in_month", "is_partial_month", "net_gmv_per_active_day", "product_sales_before_returns",
]
MOM_COLUMNS = ["net_gmv", "return_rate", "top20_coverage", "top50_coverage", "hhi"]


#: Digits of the parts that money units are cut into for sums of squares.
LIMB = 13


def hhi_expr(sum_sq, total):
    """Sum of squared shares = sum(x^2) / (sum x)^2; 0 when the total is not positive."""
    t = as_double(total)
    return F.when(t > 0, F.col(sum_sq) / (t * t)).otherwise(F.lit(0.0))


def invoice_months(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Sums per (month, invoice) over dated lines: PRODUCT lines (all and
    identified-only), RETURN lines and the latest timestamp of any line.
    Every column adds up (``_g_max_ts``: takes the largest), so frames of
    different lines can be merged."""
    prod = F.col(S.TYPE) == S.TYPE_PRODUCT
    ret = F.col(S.TYPE) == S.TYPE_RETURN
    ident = prod & F.col(S.CUSTOMER).isNotNull()

    def when(cond, c):
        return F.when(cond, F.col(c) if isinstance(c, str) else c)

    dated = fact.filter(F.col(month_col).isNotNull())
    return dated.groupBy(month_col, S.INVOICE).agg(
        F.count(when(prod, F.lit(1))).alias("_p_rows"),
        F.sum(when(prod, "net_gmv")).alias("_p_net"),
        F.sum(when(prod, S.QUANTITY)).alias("_p_units"),
        F.sum(when(prod, money(S.UNIT_PRICE, money_scale(fact)))).alias("_p_price"),
        F.count(when(ident, F.lit(1))).alias("_i_rows"),
        F.sum(when(ident, "net_gmv")).alias("_i_net"),
        F.count(when(ret, F.lit(1))).alias("_r_rows"),
        F.sum(when(ret, "return_value")).alias("_r_value"),
        F.sum(when(ret, "abs_quantity")).alias("_r_units"),
        F.max(S.INVOICE_DATE).alias("_g_max_ts"),
    )


def active_days(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Distinct (month, day) with PRODUCT lines."""
    return product_lines(fact, month_col).select(month_col, S.ORDER_DATE).distinct()


def month_facts(
    fact: DataFrame | None,
    month_col: str = S.MONTH,
    cust: DataFrame | None = None,
    invoices: DataFrame | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """One row per dated month holding everything the month-level tables
    need: PRODUCT totals and distinct counts (all and identified-only),
    RETURN totals and the latest timestamp of any line.

    No multi-distinct ``Expand``: lines first collapse to (month, invoice)
    groups -- a balanced shuffle, combined map-side -- so distinct orders
    become counts of groups and every sum rolls up from the groups.  Distinct
    customers are the rows of the customer-month aggregate and distinct days
    those of a small (month, day) table (pass ``cust``, ``invoices`` or
    ``days`` to share them).  Catalyst drops what a caller does not select.
    ``_prod_rows > 0`` marks a KPI month.
    """
    from tillroll.operators.customer import customer_month_sales

    invoices = invoices if invoices is not None else invoice_months(fact, month_col)
    months = invoices.groupBy(month_col).agg(
        F.sum("_p_rows").alias("_prod_rows"),
        F.sum("_p_net").alias("_net"),
        F.count(F.when(F.col("_p_rows") > 0, F.lit(1))).alias("_orders"),
        F.sum("_p_units").alias("_units"),
        F.sum("_p_price").alias("_price_sum"),
        F.sum("_p_rows").alias("_price_n"),  # UnitPrice is never null after cleaning
        F.sum("_i_rows").alias("_id_rows"),
        F.count(F.when(F.col("_i_rows") > 0, F.lit(1))).alias("_id_orders"),
        F.sum("_i_net").alias("_id_net"),
        F.sum("_r_rows").alias("_ret_rows"),
        F.sum("_r_value").alias("_ret_value"),
        F.sum("_r_units").alias("_ret_units"),
        F.max("_g_max_ts").alias("_max_ts"),
    )
    days = days if days is not None else active_days(fact, month_col)
    days = days.groupBy(month_col).agg(F.count(F.lit(1)).alias("_days"))
    cust = cust if cust is not None else customer_month_sales(fact, month_col)
    customers = cust.groupBy(month_col).agg(F.count(F.lit(1)).alias("_customers"))
    # One row per month on each side: bounded by the month count.
    out = months.join(F.broadcast(days), month_col, "left").join(F.broadcast(customers), month_col, "left")
    return out.withColumn("_days", F.coalesce("_days", F.lit(0))).withColumn(
        "_customers", F.coalesce("_customers", F.lit(0))
    )


def partial_flag(facts: DataFrame, month_col: str = S.MONTH) -> Column:
    """``is_partial_month`` over a ``month_facts`` frame (window over months):
    only the dataset's last month, and only when its latest timestamp falls
    before the month's last day."""
    last = F.max(month_col).over(Window.partitionBy())
    return (F.col(month_col) == last) & (F.to_date("_max_ts") < F.last_day(month_col))


def product_month_core(fact: DataFrame, month_col: str = S.MONTH, facts: DataFrame | None = None) -> DataFrame:
    """Per month over PRODUCT lines: sales, distinct orders / customers / days,
    units and the unweighted mean unit price."""
    facts = facts if facts is not None else month_facts(fact, month_col)
    return facts.where("_prod_rows > 0").select(
        month_col,
        as_double("_net").alias("net_gmv"),
        F.col("_orders").alias("order"),
        F.col("_customers").alias("customer"),
        F.col("_units").alias("unit_sold"),
        (as_double("_price_sum") / F.col("_price_n")).alias("avg_unit_price"),
        F.col("_days").alias("active_order_days"),
    )


def return_month(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Per month over RETURN lines: return value (signed) and returned units."""
    r = return_lines(fact, month_col)
    return r.groupBy(month_col).agg(
        as_double(F.sum("return_value")).alias("return_value"),
        F.sum("abs_quantity").alias("return_unit"),
    )


def sku_month(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Exact PRODUCT sales per (month, StockCode), as DECIMAL."""
    return product_lines(fact, month_col).groupBy(month_col, S.STOCK).agg(F.sum("net_gmv").alias("net_gmv"))


def sku_month_rank(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Every SKU of every month with its sales rank (ties by StockCode)."""
    ranked = rank_by_value(sku_month(fact, month_col), [month_col], "net_gmv", S.STOCK)
    return ranked.select(month_col, S.STOCK, as_double("net_gmv").alias("net_gmv"), "rank")


def _ten_to(digits: int) -> Column:
    return F.lit(str(10**digits)).cast(f"decimal({digits + 1},0)")


def _whole_part(value: Column, digits: int) -> Column:
    """``value`` without its last ``digits`` digits (whole decimals, >= 0)."""
    unit = _ten_to(digits)
    return ((value - value % unit) / unit).cast("decimal(38,0)")


def _last_part(value: Column, digits: int) -> Column:
    return (value % _ten_to(digits)).cast(f"decimal({digits},0)")


def _totals_and_squares(sku: DataFrame, month_col: str, value: str = "net_gmv") -> DataFrame:
    """Per month: exact total and sum of squares (double) of per-item sales.

    A value in whole money units is cut into three parts of ``LIMB`` digits;
    the products of the parts are added as whole numbers, one sum for each
    power of 10 ** LIMB, so no size of a value changes how it is added and the
    result does not depend on the order of addition.  The sums are carried
    into one another and go to double as an upper and a lower exact part."""
    scale = money_scale(sku, value)
    if scale > LIMB:
        raise ValueError(f"money columns with more than {LIMB} decimals have no exact sum of squares")
    # The lowest part holds the decimals and the first digits before them.
    size = F.abs(F.col(value))
    cut = _ten_to(LIMB - scale)
    lowest = ((size % cut).cast(f"decimal({LIMB},{scale})") * F.lit(10**scale)).cast(f"decimal({LIMB},0)")
    upper = ((size - size % cut) / cut).cast("decimal(38,0)")
    parts = sku.select(
        month_col,
        value,
        lowest.alias("_0"),
        _last_part(upper, LIMB).alias("_1"),
        _last_part(_whole_part(upper, LIMB), LIMB).alias("_2"),
    )
    x = [F.col(c) for c in ("_0", "_1", "_2")]
    powers = [x[0] * x[0], x[0] * x[1] * 2, x[0] * x[2] * 2 + x[1] * x[1], x[1] * x[2] * 2, x[2] * x[2]]
    sums = parts.groupBy(month_col).agg(
        F.sum(value).alias("_total"), *[F.sum(c.cast("decimal(28,0)")).alias(f"_s{k}") for k, c in enumerate(powers)]
    )
    # Carry: digits _d0 .. _d5 of LIMB decimal digits each.
    carry = None
    for k in range(5):
        held = F.col(f"_s{k}") if carry is None else (F.col(f"_s{k}") + F.col(carry)).cast("decimal(38,0)")
        sums = sums.withColumn(f"_h{k}", held)
        sums = sums.withColumn(f"_d{k}", _last_part(F.col(f"_h{k}"), LIMB)).withColumn(
            f"_c{k}", _whole_part(F.col(f"_h{k}"), LIMB)
        )
        carry = f"_c{k}"

    def at(c: Column, digits: int) -> Column:
        return (c.cast("decimal(38,0)") * _ten_to(digits)).cast("decimal(38,0)")

    low = at(_last_part(F.col("_d1").cast("decimal(38,0)"), 2), 13) + F.col("_d0")
    high = _whole_part(F.col("_d1").cast("decimal(38,0)"), 2) + at(F.col("_d2"), 11) + at(F.col("_d3"), 24)
    top = as_double("_d4") + as_double("_c4") * F.lit(1e13)
    exact = (top * F.lit(1e37) + high.cast("double")) * F.lit(1e15) + low.cast("double")
    return sums.select(month_col, "_total", (exact / F.lit(float(10 ** (2 * scale)))).alias("_sq"))


def sku_concentration(
    fact: DataFrame | None, month_col: str = S.MONTH, ns=(20, 50), sku: DataFrame | None = None
) -> DataFrame:
    """``top{n}_coverage`` for each n in ``ns`` plus ``hhi`` from one SKU-month
    frame (``sku`` to share it).

    Totals and squares are one aggregate; the top-N sums read only the
    ``max(ns)`` best SKUs per month (group-limited before the shuffle).  Spark
    reuses the shared SKU-month exchange for both branches.
    """
    sku = sku if sku is not None else sku_month(fact, month_col)
    totals = _totals_and_squares(sku, month_col)
    best = top_by_value(sku, [month_col], "net_gmv", S.STOCK, max(ns), "_rank")
    tops = best.groupBy(month_col).agg(
        *[F.sum(F.when(F.col("_rank") <= n, F.col("net_gmv"))).alias(f"_top{n}") for n in ns]
    )
    joined = totals.join(tops, month_col, "left")
    return joined.select(
        month_col,
        *[safe_ratio(F.coalesce(as_double(f"_top{n}"), F.lit(0.0)), as_double("_total")).alias(f"top{n}_coverage")
          for n in ns],
        hhi_expr("_sq", "_total").alias("hhi"),
    )


def topn_coverage(fact: DataFrame, month_col: str = S.MONTH, n: int = 50) -> DataFrame:
    """Share of a month's PRODUCT sales from its ``n`` best-selling SKUs."""
    return sku_concentration(fact, month_col, (n,)).select(month_col, f"top{n}_coverage")


def sku_hhi(fact: DataFrame, month_col: str = S.MONTH) -> DataFrame:
    """Herfindahl index of SKU sales shares per month (0..1)."""
    totals = _totals_and_squares(sku_month(fact, month_col), month_col)
    return totals.select(month_col, hhi_expr("_sq", "_total").alias("hhi"))


def monthly_kpis(
    fact: DataFrame | None,
    month_col: str = S.MONTH,
    facts: DataFrame | None = None,
    ns=(20, 50),
    sku: DataFrame | None = None,
) -> DataFrame:
    """The 17-column monthly KPI table, one row per month with PRODUCT lines.

    Months holding only returns are not KPI months.  ``return_rate`` is
    |returns| / (sales + |returns|); ``net_gmv`` is product sales before
    returns.  Reads ``month_facts`` and the SKU-month aggregate behind coverage
    and HHI (pass ``facts`` or ``sku`` in to share them).
    """
    facts = facts if facts is not None else month_facts(fact, month_col)
    facts = facts.select("*", partial_flag(facts, month_col).alias("is_partial_month"))
    facts = facts.filter(F.col("_prod_rows") > 0)
    conc = sku_concentration(fact, month_col, ns, sku)
    # One row per month on the right: bounded by the month count.
    df = facts.join(F.broadcast(conc), month_col, "left")
    net = as_double("_net")
    rv = F.coalesce(as_double("_ret_value"), F.lit(0.0))
    total = net + F.abs(rv)
    return df.select(
        F.col(month_col),
        net.alias("net_gmv"),
        F.col("_orders").alias("order"),
        F.col("_customers").alias("customer"),
        F.col("_units").alias("unit_sold"),
        (as_double("_price_sum") / F.col("_price_n")).alias("avg_unit_price"),
        F.col("_days").alias("active_order_days"),
        rv.alias("return_value"),
        F.coalesce(F.col("_ret_units"), F.lit(0)).cast("bigint").alias("return_unit"),
        F.when(total > 0, F.abs(rv) / total).otherwise(F.lit(0.0)).alias("return_rate"),
        *[F.col(f"top{n}_coverage") for n in ns],
        "hhi",
        days_in_month(month_col).alias("calendar_days_in_month"),
        F.col("is_partial_month"),
        safe_ratio(net, "_days").alias("net_gmv_per_active_day"),
        net.alias("product_sales_before_returns"),
    )


def mom_variance(kpi: DataFrame, month_col: str = S.MONTH, columns=MOM_COLUMNS) -> DataFrame:
    """Adds ``{c}_mom`` = c / previous row's c - 1 (first row null; a zero base
    gives +/-inf, or NaN for 0/0).  Runs over the one-row-per-month table."""
    w = Window.orderBy(month_col)
    return kpi.select("*", *[pct_change(F.col(c), F.lag(c).over(w)).alias(f"{c}_mom") for c in columns])


def kpi_with_prev(kpi: DataFrame, month_col: str = S.MONTH, columns=MOM_COLUMNS) -> DataFrame:
    """SQL-style variant: ``prev_{c}`` and ``{c}_mom`` = (c - prev) / prev,
    NULL when there is no previous month or the base is zero."""
    w = Window.orderBy(month_col)
    extra = []
    for c in columns:
        prev = F.lag(c).over(w)
        extra += [prev.alias(f"prev_{c}"), change_or_null(F.col(c), prev).alias(f"{c}_mom")]
    return kpi.select("*", *extra)
