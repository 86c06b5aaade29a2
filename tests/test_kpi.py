import datetime as dt
import math

import pytest
from conftest import line, rows

from tillroll import operators as ops

D = dt.date


def test_t9_return_only_month(fact):
    f = fact([line(inv="1", date="2011-01-03"), line(inv="c2", date="2011-02-03", qty=-2, price=5.0)])
    assert rows(ops.monthly_kpis(f), "month") == [(D(2011, 1, 1),)]
    assert rows(ops.top_return_skus(f), "month", "return_burden", "return_units", "rank") == [
        (D(2011, 2, 1), 10.0, 2, 1)
    ]


def test_t10_month_without_returns(fact):
    k = ops.monthly_kpis(fact([line(qty=2, price=3.0)])).collect()[0]
    assert (k.return_value, k.return_unit, k.return_rate) == (0.0, 0, 0.0)
    assert k.net_gmv == 6.0 and k.product_sales_before_returns == 6.0


def test_t11_zero_sales_month(fact):
    k = ops.monthly_kpis(fact([line(qty=0)])).collect()[0]
    assert (k.top20_coverage, k.top50_coverage, k.hhi, k.return_rate, k.net_gmv_per_active_day) == (
        0.0, 0.0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("last_day,partial", [("2011-01-31", False), ("2011-01-30", True)])
def test_t12_partial_flag(fact, last_day, partial):
    f = fact([line(inv="1", date="2010-12-05"), line(inv="2", date=last_day)])
    assert rows(ops.monthly_kpis(f), "month", "is_partial_month", order=["month"]) == [
        (D(2010, 12, 1), False), (D(2011, 1, 1), partial)]


def test_t12_time_of_day_on_last_day(fact):
    f = fact([line(inv="1", date="2011-01-31T23:59:00")])
    assert rows(ops.monthly_kpis(f), "is_partial_month") == [(False,)]


def test_t13_latest_date_from_non_product_line(fact):
    f = fact([line(inv="1", date="2010-12-05"), line(inv="2", desc="POSTAGE", date="2011-01-10")])
    assert rows(ops.monthly_kpis(f), "month", "is_partial_month") == [(D(2010, 12, 1), False)]


def test_kpi_values(fact):
    data = [
        line(inv="1", stock="A", qty=2, price=10.0, cust=1, date="2011-01-02"),
        line(inv="1", stock="B", qty=1, price=5.0, cust=1, date="2011-01-02"),
        line(inv="2", stock="A", qty=1, price=10.0, cust=None, date="2011-01-03"),
        line(inv="c3", stock="A", qty=-1, price=10.0, cust=1, date="2011-01-04"),
        line(inv="4", stock="POST", desc="POSTAGE", qty=1, price=30.0, cust=2, date="2011-01-31"),
    ]
    k = ops.monthly_kpis(fact(data)).collect()[0].asDict()
    assert k["net_gmv"] == 35.0 and k["order"] == 2 and k["customer"] == 1 and k["unit_sold"] == 4
    assert k["avg_unit_price"] == pytest.approx(25.0 / 3) and k["active_order_days"] == 2
    assert k["return_value"] == -10.0 and k["return_unit"] == 1
    assert k["return_rate"] == pytest.approx(10.0 / 45.0)
    assert k["top20_coverage"] == 1.0 and k["hhi"] == pytest.approx((30 / 35) ** 2 + (5 / 35) ** 2, rel=1e-14)
    assert k["calendar_days_in_month"] == 31 and k["is_partial_month"] is False
    assert k["net_gmv_per_active_day"] == 17.5


def test_t17_ties_rank_by_stock_code(fact):
    data = [line(inv=str(i), stock=s, qty=1, price=5.0) for i, s in enumerate(["C", "A", "B"])]
    data.append(line(inv="9", stock="Z", qty=1, price=9.0))
    f = fact(data)
    r = rows(ops.sku_month_rank(f), "StockCode", "rank", order=["rank"])
    assert r == [("Z", 1), ("A", 2), ("B", 3), ("C", 4)]
    cov = ops.topn_coverage(f, n=2).collect()[0][1]
    assert cov == pytest.approx(14.0 / 24.0)


def test_t18_mom_zero_base(spark):
    kpi = spark.createDataFrame(
        [(D(2011, 1, 1), 1.0, 0.0, 0.1, 0.1, 0.0), (D(2011, 2, 1), 2.0, 0.0, 0.2, 0.1, 0.5),
         (D(2011, 3, 1), 1.0, 0.0, 0.1, 0.1, 0.0), (D(2011, 4, 1), 1.0, 0.0, 0.1, 0.1, 0.0)],
        "month date, net_gmv double, return_rate double, top20_coverage double, top50_coverage double, hhi double",
    )
    m = rows(ops.mom_variance(kpi), "month", "net_gmv_mom", "return_rate_mom", "hhi_mom", order=["month"])
    assert m[0][1:] == (None, None, None)
    assert m[1][1] == 1.0 and math.isnan(m[1][2]) and m[1][3] == math.inf
    assert m[2][3] == -1.0 and math.isnan(m[3][3])
    p = rows(ops.kpi_with_prev(kpi), "month", "prev_hhi", "hhi_mom", order=["month"])
    assert p[1] == (D(2011, 2, 1), 0.0, None) and p[3] == (D(2011, 4, 1), 0.0, None)
    assert p[2] == (D(2011, 3, 1), 0.5, -1.0)


def test_golden_mom_from_published_kpis(spark):
    # The first three published monthly KPI rows and their
    # published changes (all 13 are in test_golden.py).
    kpi = spark.createDataFrame(
        [
            (D(2010, 12, 1), 778608.36, 0.022114420125729166, 0.202219560036576, 0.3189456506734657,
             0.003935121097785327),
            (D(2011, 1, 1), 672192.41, 0.11990056518549967, 0.26470873123961636, 0.35499177980899843,
             0.01563376200691989),
            (D(2011, 2, 1), 509167.87, 0.01618388814827516, 0.14608215557670595, 0.2502079127655875,
             0.0026016259925383915),
        ],
        "month date, net_gmv double, return_rate double, top20_coverage double, top50_coverage double, hhi double",
    )
    got = rows(ops.mom_variance(kpi), "net_gmv_mom", "return_rate_mom", "top20_coverage_mom",
               "top50_coverage_mom", "hhi_mom", order=["month"])
    assert got[0] == (None,) * 5
    expected = [
        (-0.13667455355860803, 4.42182722874115, 0.309016453164757, 0.11301652510206672, 2.9728795171560334),
        (-0.24252660038217333, -0.8650224198423346, -0.4481400183038493, -0.29517265751840605,
         -0.833589254372246),
    ]
    for g, e in zip(got[1:], expected):
        assert g == pytest.approx(e, rel=1e-12)


def test_t22_repartitioned_input_same_result(fact):
    import random

    random.seed(7)
    data = []
    for i in range(400):
        m = random.choice(["2010-12-03", "2011-01-04", "2011-02-05", "2011-03-01"])
        data.append(line(inv=f"{'c' if i % 17 == 0 else ''}{i // 3}", stock=f"S{random.randint(1, 30)}",
                         qty=random.choice([1, 2, 3, -1]), price=random.choice([0.5, 1.25, 2.0]),
                         cust=random.choice([None, 1, 2, 3, 4, 5]), date=m))
    f = fact(data)
    base = {name: sorted(rows(fn(f))) for name, fn in _ops().items()}
    for n in (1, 7, 50):
        g = f.repartition(n)
        for name, fn in _ops().items():
            assert sorted(rows(fn(g))) == base[name], (name, n)


def _ops():
    return {
        "kpi": ops.monthly_kpis,
        "returns": ops.top_return_skus,
        "conc": lambda f: ops.customer_concentration(f, n=2),
        "rank": ops.sku_month_rank,
        "retention": ops.retention,
        "cohort": ops.cohort_table,
    }


def test_return_ties_stock_then_description_nulls_last(fact):
    data = [
        line(inv="c1", stock="B", desc="X", qty=-1, price=2.0),
        line(inv="c2", stock="A", desc=None, qty=-1, price=2.0),
        line(inv="c3", stock="A", desc="Z", qty=-1, price=2.0),
        line(inv="c4", stock="A", desc="Y", qty=-2, price=1.0),
        line(inv="c5", stock="C", desc="W", qty=-1, price=1.0),
    ]
    got = rows(ops.top_return_skus(fact(data), top_n=4), "StockCode", "Description", "rank", order=["rank"])
    assert got == [("A", "Y", 1), ("A", "Z", 2), ("A", None, 3), ("B", "X", 4)]


def test_kpi_column_order(fact):
    from tillroll.operators.kpi import KPI_COLUMNS

    assert ops.monthly_kpis(fact([line()])).columns == KPI_COLUMNS


def test_month_col_parameter_is_honoured(fact):
    import random

    random.seed(3)
    data = [line(inv=f"{'c' if i % 9 == 0 else ''}{i // 2}", stock=f"S{i % 7}", qty=random.choice([1, 2, -1]),
                 cust=random.choice([None, 1, 2, 3]), date=random.choice(["2011-01-04", "2011-02-05", "2011-03-02"]))
            for i in range(60)]
    f = fact(data)
    g = f.withColumnRenamed("month", "period")
    pairs = [
        (ops.monthly_kpis(f), ops.monthly_kpis(g, month_col="period")),
        (ops.customer_id_coverage(f), ops.customer_id_coverage(g, month_col="period")),
        (ops.retention(f), ops.retention(g, month_col="period")),
        (ops.customer_concentration(f, n=2), ops.customer_concentration(g, month_col="period", n=2)),
        (ops.cohort_table(f, freq="Q"), ops.cohort_table(g, month_col="period", freq="Q")),
        (ops.top_return_skus(f), ops.top_return_skus(g, month_col="period")),
        (ops.sku_month_rank(f), ops.sku_month_rank(g, month_col="period")),
    ]
    for a, b in pairs:
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    kpi_g = ops.monthly_kpis(g, month_col="period")
    assert rows(ops.mom_variance(kpi_g, month_col="period"), "net_gmv_mom", order=["period"])[0] == (None,)
    assert ops.latest_full_month(kpi_g, month_col="period").count() == 1


def test_hhi_keeps_its_digits(spark):
    """Many equal items: the index is 1 / n to 15 digits, however small."""
    from pyspark.sql import functions as F

    from tillroll.operators.kpi import _totals_and_squares, hhi_expr

    n = 3_000_000
    sku = spark.range(n).select(F.lit("m").alias("month"), F.lit("12.34").cast("decimal(38,8)").alias("net_gmv"))
    got = _totals_and_squares(sku, "month").select(hhi_expr("_sq", "_total").alias("h")).first().h
    assert abs(got * n - 1) < 1e-14
    huge = spark.range(2).select(F.lit("m").alias("month"), F.lit("1e18").cast("decimal(38,8)").alias("net_gmv"))
    assert _totals_and_squares(huge, "month").select(hhi_expr("_sq", "_total").alias("h")).first().h == 0.5


def test_hhi_is_exact_at_every_size(spark):
    """Sums of squares equal whole-number arithmetic to the last bit, in any
    order of the rows, from single units to SKU-months of 1e12 and more."""
    import random
    from decimal import Decimal

    from tillroll.operators.kpi import _totals_and_squares

    rng = random.Random(4)
    months = {"small": 3, "mixed": 0, "large": 12, "huge": 26}
    data = []
    for month, digits in months.items():
        for _ in range(300):
            size = digits or rng.randrange(1, 24)
            data.append((month, Decimal(rng.randrange(10 ** (size + 8))).scaleb(-8)))
    data.append(("one", Decimal("0.00000001")))
    want = {}
    for month in [*months, "one"]:
        units = [int(v.scaleb(8)) for m, v in data if m == month]
        square = sum(u * u for u in units)
        want[month] = ((float(square // 10**52) * 1e37 + float(square // 10**15 % 10**37)) * 1e15 + float(square % 10**15)) / 1e16
        assert abs(want[month] / (square / 1e16) - 1) < 1e-15
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        sku = spark.createDataFrame(data, "month string, net_gmv decimal(38,8)").repartition(7)
        got = {r["month"]: r["_sq"] for r in _totals_and_squares(sku, "month").collect()}
        assert got == want


def test_product_month_core_has_no_expand(fact):
    plan = ops.product_month_core(fact([line()]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
