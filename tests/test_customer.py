import datetime as dt

import pytest
from conftest import line, rows

from tillroll import operators as ops

D = dt.date


def test_t14_next_observed_month(fact):
    f = fact([line(inv="1", cust=1, date="2011-01-05"), line(inv="2", cust=1, date="2011-02-05"),
              line(inv="3", cust=1, date="2011-04-05"), line(inv="4", cust=2, date="2011-02-06")])
    assert rows(ops.retention(f), order=["month"]) == [
        (D(2011, 1, 1), 1, 1, 1.0), (D(2011, 2, 1), 2, 1, 0.5)]


def test_t15_unidentified_middle_month(fact):
    f = fact([line(inv="1", cust=1, date="2011-01-05"), line(inv="2", cust=None, date="2011-02-05"),
              line(inv="3", cust=1, date="2011-03-05")])
    assert rows(ops.retention(f), order=["month"]) == [(D(2011, 1, 1), 1, 0, 0.0), (D(2011, 2, 1), 0, 0, 0.0)]
    assert rows(ops.retention_identified_calendar(f)) == [(D(2011, 1, 1), 1, 1, 1.0)]
    assert [r[0] for r in rows(ops.customer_concentration(f, n=10), order=["month"])] == [
        D(2011, 1, 1), D(2011, 3, 1)]
    cov = {r[0]: r for r in rows(ops.customer_id_coverage(f))}
    assert cov[D(2011, 2, 1)][4:] == (0, 0, 0.0, 0.0, 0.0, 0.0)


def test_t16_single_month_retention_empty_with_schema(fact):
    r = ops.retention(fact([line()]))
    assert r.count() == 0
    assert r.columns == ["month", "current_customers", "repeat_customers", "next_month_repeat_rate"]


def test_t19_cohorts_by_frequency(fact):
    f = fact([line(inv="1", cust=7, date="2010-12-05"), line(inv="2", cust=7, date="2011-01-05"),
              line(inv="3", cust=8, date="2011-01-09"), line(inv="4", cust=None, date="2010-11-01")])
    assert sorted(rows(ops.cohort_table(f, freq="M"))) == [("2010-12", 0, 1), ("2010-12", 1, 1), ("2011-01", 0, 1)]
    assert sorted(rows(ops.cohort_table(f, freq="Q"))) == [("2010Q4", 0, 1), ("2010Q4", 1, 1), ("2011Q1", 0, 1)]
    assert sorted(rows(ops.cohort_table(f, freq="Y"))) == [("2010", 0, 1), ("2010", 1, 1), ("2011", 0, 1)]


def test_t20_bad_frequency(fact):
    with pytest.raises(ValueError):
        ops.cohort_table(fact([line()]), freq="W")


def test_concentration_values(fact):
    f = fact([line(inv="1", cust=1, qty=3, price=10.0), line(inv="2", cust=2, qty=1, price=10.0),
              line(inv="3", cust=3, qty=1, price=10.0), line(inv="4", cust=None, qty=9, price=10.0)])
    r = ops.customer_concentration(f, n=1).collect()[0]
    assert r.top1_share == pytest.approx(0.6)
    assert abs(r.customer_hhi - 0.44) < 1e-15
    ranks = rows(ops.customer_month_rank(f), "CustomerID", "rank", order=["rank"])
    assert ranks == [(1, 1), (2, 2), (3, 3)]


def test_coverage_values(fact):
    f = fact([line(inv="1", cust=1, qty=1, price=10.0), line(inv="1", cust=1, qty=1, price=10.0),
              line(inv="2", cust=None, qty=2, price=10.0)])
    r = ops.customer_id_coverage(f).collect()[0].asDict()
    assert r["total_product_rows"] == 3 and r["identified_product_rows"] == 2
    assert r["total_product_orders"] == 2 and r["identified_product_orders"] == 1
    assert r["identified_sales_coverage"] == 0.5 and r["identified_order_coverage"] == 0.5


def test_customer_rank_ties_by_id(fact):
    f = fact([line(inv=str(c), cust=c, qty=1, price=5.0) for c in (9, 3, 7)] + [line(inv="x", cust=1, qty=3, price=5.0)])
    assert rows(ops.customer_month_rank(f), "CustomerID", "rank", order=["rank"]) == [(1, 1), (3, 2), (7, 3), (9, 4)]
    r = ops.customer_concentration(f, n=2).collect()[0]
    assert r.top2_share == pytest.approx(20.0 / 30.0)
