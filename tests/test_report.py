import datetime as dt

import pytest
from conftest import line, rows

from tillroll import operators as ops
from tillroll.functions.columns import fmt_decimal, fmt_money, fmt_pct

D = dt.date


def _kpi_health(fact, data):
    f = fact(data)
    kpi = ops.monthly_kpis(f)
    health = ops.customer_health_monthly(
        ops.customer_id_coverage(f), ops.retention(f), ops.customer_concentration(f, n=10))
    return f, kpi, health


def test_t21_all_full_and_all_partial(fact):
    _, kpi, _ = _kpi_health(fact, [line(inv="1", date="2011-01-31")])
    assert ops.partial_month_notice(kpi).count() == 0
    assert rows(ops.latest_full_month(kpi), "month") == [(D(2011, 1, 1),)]
    _, kpi, health = _kpi_health(fact, [line(inv="1", date="2011-01-05")])
    assert ops.latest_full_month(kpi).count() == 0
    assert rows(ops.partial_month_notice(kpi)) == [(D(2011, 1, 1),)]
    assert ops.report_snapshot(kpi, health).count() == 0


def test_stable_retention_and_snapshot(fact):
    data = [
        line(inv="1", cust=1, date="2011-01-05", qty=2, price=10.0),
        line(inv="2", cust=1, date="2011-02-05", qty=1, price=10.0),
        line(inv="3", cust=2, date="2011-02-05", qty=1, price=10.0),
        line(inv="4", cust=1, date="2011-03-05", qty=1, price=10.0),
        line(inv="5", cust=2, date="2011-04-02", qty=1, price=10.0),
        line(inv="c6", cust=2, date="2011-03-07", qty=-1, price=10.0),
    ]
    _, kpi, health = _kpi_health(fact, data)
    # 2011-04 is partial: latest full month is 2011-03; 2011-03's retention
    # is not stable (its next month is partial), so 2011-02 is the latest.
    assert rows(ops.latest_stable_retention(health, kpi), "month", "next_month_repeat_rate") == [
        (D(2011, 2, 1), 0.5)]
    snap = ops.report_snapshot(kpi, health).collect()[0].asDict()
    assert snap["month"] == D(2011, 3, 1) and snap["retention_month"] == D(2011, 2, 1)
    assert snap["next_month_repeat_rate"] == 0.5 and snap["retention_text"] == "50.0%"
    assert snap["return_value_abs"] == 10.0 and snap["return_value_text"] == "10"
    assert snap["return_rate_text"] == "50.0%" and snap["sales_text"] == "10"
    assert snap["hhi_text"] == "1.0000" and snap["identified_sales_coverage_text"] == "100.0%"


def test_watchlist_and_dim_month(fact):
    data = [line(inv=f"c{i}", stock=f"S{i}", qty=-i, price=1.0, date="2011-01-05") for i in range(1, 9)]
    data.append(line(inv="100", date="2011-01-31"))
    f, kpi, _ = _kpi_health(fact, data)
    wl = rows(ops.return_watchlist(ops.top_return_skus(f), kpi), "StockCode", "rank", "return_burden_text",
              order=["rank"])
    assert wl == [("S8", 1, "8"), ("S7", 2, "7"), ("S6", 3, "6"), ("S5", 4, "5"), ("S4", 5, "4")]
    assert rows(ops.dim_month(kpi)) == [(D(2011, 1, 1), False, D(2011, 1, 1), 2011, 1, "2011-01")]


def test_series_long(fact):
    _, kpi, health = _kpi_health(fact, [line(inv="1", date="2011-01-05"), line(inv="2", date="2011-02-05")])
    f = fact([line(inv="1", date="2011-01-05"), line(inv="2", date="2011-02-05")])
    s = ops.kpi_series_long(kpi, health, ops.retention(f))
    assert sorted(set(r[0] for r in rows(s, "series"))) == sorted(
        ["product_sales_before_returns", "return_rate", "top50_coverage", "hhi", "identified_sales_coverage",
         "next_month_repeat_rate"])
    assert s.count() == 4 * 2 + 2 + 1


@pytest.mark.parametrize("x", [0.0, 2.5, 3.5, 1234567.5, 0.125, 0.0005, 99.95, -1234.5, 2.675])
def test_formats_match_python(spark, x):
    df = spark.createDataFrame([(x,)], "x double")
    got = df.select(fmt_money("x"), fmt_pct("x"), fmt_decimal("x", 4)).collect()[0]
    assert tuple(got) == (f"{x:,.0f}", f"{x * 100:.1f}%", f"{x:.4f}")


def test_formats_missing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert tuple(df.select(fmt_money("x"), fmt_pct("x"), fmt_decimal("x")).collect()[0]) == ("NA", "NA", "NA")
