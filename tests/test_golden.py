"""Golden checks on the published output tables (values copied as literals).

The month-grain report operators take the published tables as input and
must reproduce the published selections: latest full month 2011-11, latest
stable retention 2011-10 (2011-11 is excluded because 2011-12 is partial),
partial month 2011-12, and the 2011-11 return watchlist.
"""

import datetime as dt

import pytest
from conftest import rows

from tillroll import operators as ops

# --- published values -------------------------------------------------------
MONTHS = ["2010-12", "2011-01", "2011-02", "2011-03", "2011-04", "2011-05", "2011-06",
          "2011-07", "2011-08", "2011-09", "2011-10", "2011-11", "2011-12"]
PARTIAL = [False] * 12 + [True]
REPEAT_RATE = [0.36538461538461536, 0.35182679296346414, 0.38309114927344784, 0.30935251798561153,
               0.42907385697538103, 0.3889943074003795, 0.3686868686868687, 0.4080338266384778,
               0.4533762057877814, 0.3868149324861001, 0.45260837619397504, 0.22289156626506024, None]
TOP_RETURNS_2011_11 = [
    ("21843", "RED RETROSPOT CAKE STAND", 1342.95, 213, 1),
    ("22423", "REGENCY CAKESTAND 3 TIER", 1001.0999999999999, 86, 2),
    ("22635", "CHILDS BREAKFAST SET DOLLY GIRL ", 637.5, 75, 3),
    ("72807C", "SET/3 VANILLA SCENTED CANDLE IN BOX", 482.7, 126, 4),
    ("22991", "GIRAFFE WOODEN RULER", 475.2, 288, 5),
    ("22992", "REVOLVER WOODEN RULER ", 455.4, 276, 6),
]
# ---------------------------------------------------------------------------


def _d(m):
    y, mo = map(int, m.split("-"))
    return dt.date(y, mo, 1)


def _kpi(spark):
    return spark.createDataFrame([(_d(m), p) for m, p in zip(MONTHS, PARTIAL)], "month date, is_partial_month boolean")


def _health(spark):
    return spark.createDataFrame([(_d(m), r) for m, r in zip(MONTHS, REPEAT_RATE)],
                                 "month date, next_month_repeat_rate double")


def test_latest_full_month(spark):
    assert rows(ops.latest_full_month(_kpi(spark)), "month") == [(dt.date(2011, 11, 1),)]


def test_latest_stable_retention(spark):
    assert rows(ops.latest_stable_retention(_health(spark), _kpi(spark))) == [
        (dt.date(2011, 10, 1), 0.45260837619397504)]


def test_partial_month_notice(spark):
    assert rows(ops.partial_month_notice(_kpi(spark))) == [(dt.date(2011, 12, 1),)]


def test_dim_month(spark):
    got = rows(ops.dim_month(_kpi(spark)), order=["month"])
    assert got[0] == (dt.date(2010, 12, 1), False, dt.date(2010, 12, 1), 2010, 12, "2010-12")
    assert got[-1] == (dt.date(2011, 12, 1), True, dt.date(2011, 12, 1), 2011, 12, "2011-12")
    assert len(got) == 13


def test_return_watchlist(spark):
    top = spark.createDataFrame(
        [(dt.date(2011, 11, 1),) + r for r in TOP_RETURNS_2011_11]
        + [(dt.date(2011, 12, 1), "X", "OTHER MONTH", 9999.0, 1, 1)],
        "month date, StockCode string, Description string, return_burden double, return_units bigint, rank bigint",
    )
    got = rows(ops.return_watchlist(top, _kpi(spark)), "Description", "return_burden_text", order=["rank"])
    assert got == [("RED RETROSPOT CAKE STAND", "1,343"), ("REGENCY CAKESTAND 3 TIER", "1,001"),
                   ("CHILDS BREAKFAST SET DOLLY GIRL ", "638"), ("SET/3 VANILLA SCENTED CANDLE IN BOX", "483"),
                   ("GIRAFFE WOODEN RULER", "475")]


# --- published values: KPI columns with a month-over-month change, by month ---
# (net_gmv, return_rate, top20_coverage, top50_coverage, hhi)
KPI_VALUES = [
    (778608.36, 0.022114420125729166, 0.202219560036576, 0.3189456506734657, 0.003935121097785327),
    (672192.41, 0.11990056518549967, 0.26470873123961636, 0.35499177980899843, 0.01563376200691989),
    (509167.87, 0.01618388814827516, 0.14608215557670595, 0.2502079127655875, 0.0026016259925383915),
    (692015.94, 0.015192020893842365, 0.1565803961105289, 0.2665348575641191, 0.002928206535229512),
    (516709.791, 0.060573259333459153, 0.1907405698840338, 0.2901866630199001, 0.003678020840166419),
    (741711.74, 0.011920483784422392, 0.16664488821492834, 0.2750268992641265, 0.0031702175407185883),
    (739426.88, 0.01828968434952014, 0.19464978065173935, 0.3091265900422771, 0.005420215491926308),
    (689947.741, 0.01626733717222402, 0.15772620668671772, 0.27244669245174036, 0.002909638816778757),
    (737067.22, 0.030170550468413854, 0.16731263669546992, 0.27826843255897343, 0.002825457807835949),
    (1031400.361, 0.016257103933404935, 0.11675486508773872, 0.22394709051299236, 0.001971519302936737),
    (1107386.49, 0.0382082471305161, 0.1203641467578316, 0.21942009604975404, 0.001945095089697213),
    (1458895.53, 0.01685453042186154, 0.168656072309715, 0.27329777341904665, 0.0029537411557966193),
    (615701.6, 0.22046151900648392, 0.3995290900657072, 0.4899846776425464, 0.0765383261873777),
]
# Their published changes against the month before.
MOM_VALUES = [
    (None, None, None, None, None),
    (-0.13667455355860803, 4.42182722874115, 0.309016453164757, 0.11301652510206672, 2.9728795171560334),
    (-0.24252660038217333, -0.8650224198423346, -0.4481400183038493, -0.29517265751840605, -0.833589254372246),
    (0.3591115637363369, -0.0612873275782313, 0.07186531778900584, 0.065253511042346, 0.1255293972414835),
    (-0.25332674995896765, 2.9871758837568954, 0.21816379714221368, 0.08873813231010952, 0.2560660581539673),
    (0.4354512976511411, -0.8032055082458174, -0.12632698792792274, -0.05224142142857202, -0.13806428008843308),
    (-0.003080522899637561, 0.5343072211063258, 0.1680513140054558, 0.12398674773045548, 0.7097298284135152),
    (-0.06691552652237898, -0.11057310441495838, -0.1896923481824211, -0.11865655939050823, -0.4631876129071224),
    (0.06829427244983166, 0.8546705062417435, 0.06077892957758868, 0.02136836404525, -0.02893177271947589),
    (0.39933011944283736, -0.4611598502180191, -0.3021754519340504, -0.1952120172110028, -0.3022301386100872),
    (0.07367277720004584, 1.3502492994466357, 0.030913329970280623, -0.02021457145466099, -0.013402969577910318),
    (0.3174221856363808, -0.558877161669105, 0.4012152028049103, 0.24554577424428659, 0.5185587437046171),
    (-0.5779673133963198, 12.08025281561861, 1.3688983420177356, 0.7928601155899442, 24.912333596724874),
]
# (identified_row_coverage, identified_order_coverage, identified_sales_coverage, top10_share, customer_hhi)
COVERAGE_AND_SHARES = [
    (0.6307014784523435, 0.8994197292069632, 0.7295589787913399, 0.19229348557969578, 0.007057093318441117),
    (0.6189723320158103, 0.9093432007400555, 0.8393826404555802, 0.3425802262721945, 0.02655764313325644),
    (0.7361337683523654, 0.9075937785910339, 0.871119420791418, 0.20182812146527657, 0.007385912132786592),
    (0.7598742385537434, 0.9111111111111111, 0.8457360823220345, 0.1880796807793285, 0.0057970417822268885),
    (0.7788670647933998, 0.9222672064777327, 0.8818623508529568, 0.1506008629184839, 0.0053176162287112624),
    (0.7839519893309624, 0.9256594724220624, 0.8910711053326459, 0.18420790237335075, 0.005925522398821143),
    (0.7569153394803018, 0.9114754098360656, 0.8857299859047592, 0.2949680193026286, 0.013693922043601588),
    (0.6950800915331807, 0.9097796143250688, 0.8598214991474259, 0.2042934302685115, 0.007029380172764553),
    (0.7835468841001747, 0.9455630126771066, 0.8644492967683464, 0.25267753372778123, 0.010521172332070648),
    (0.8127801776835928, 0.9565695437053326, 0.913128254179465, 0.24569075254279008, 0.01231134213944818),
    (0.8357903288594012, 0.9491271820448878, 0.9087549009199128, 0.2155753968155387, 0.007627645194774619),
    (0.7739036275040606, 0.96037804434751, 0.7836378592509636, 0.15373648834930742, 0.0039147304749481025),
    (0.6888081163125099, 0.9509803921568627, 0.833813701312454, 0.470863682902755, 0.11124995484546334),
]
# (current_customers, repeat_customers), without the last month
REPEATS = [
    (884, 323), (739, 260), (757, 290), (973, 301), (853, 366), (1054, 410), (990, 365), (946, 386), (933, 423), (1259, 487), (1361, 616), (1660, 370),
]
# ---------------------------------------------------------------------------


def test_all_published_changes(spark):
    names = ["net_gmv", "return_rate", "top20_coverage", "top50_coverage", "hhi"]
    frame = spark.createDataFrame(
        [(_d(m), *v) for m, v in zip(MONTHS, KPI_VALUES)], "month date, " + ", ".join(f"{n} double" for n in names)
    )
    got = rows(ops.mom_variance(frame), *[f"{n}_mom" for n in names], order=["month"])
    assert got[0] == (None,) * 5
    for have, want in zip(got[1:], MOM_VALUES[1:]):
        assert have == pytest.approx(want, rel=1e-12)


def test_published_health_table(spark):
    """Coverage, retention and concentration join to the published table."""
    c = spark.createDataFrame(
        [(_d(m), *v[:3]) for m, v in zip(MONTHS, COVERAGE_AND_SHARES)],
        "month date, identified_row_coverage double, identified_order_coverage double, identified_sales_coverage double",
    )
    r = spark.createDataFrame(
        [(_d(m), *v, q) for m, v, q in zip(MONTHS, REPEATS, REPEAT_RATE)],
        "month date, current_customers long, repeat_customers long, next_month_repeat_rate double",
    )
    s = spark.createDataFrame(
        [(_d(m), *v[3:]) for m, v in zip(MONTHS, COVERAGE_AND_SHARES)], "month date, top10_share double, customer_hhi double"
    )
    got = rows(ops.customer_health_monthly(c, r, s), order=["month"])
    for i, (m, v) in enumerate(zip(MONTHS, COVERAGE_AND_SHARES)):
        middle = (*REPEATS[i], REPEAT_RATE[i]) if i < 12 else (None, None, None)
        assert got[i] == (_d(m), *v[:3], *middle, *v[3:])
    assert rows(ops.latest_stable_retention(ops.customer_health_monthly(c, r, s), _kpi(spark)), "month") == [
        (dt.date(2011, 10, 1),)
    ]


def test_snapshot_takes_the_last_stable_month_in_health(spark):
    kpi = spark.createDataFrame(
        [(dt.date(2011, m, 1), False, 1.0, 0.1, 0.2, 0.3, -1.0, 1, 1.0) for m in range(1, 5)],
        "month date, is_partial_month boolean, net_gmv double, return_rate double, top50_coverage double, hhi double, "
        "return_value double, return_unit long, product_sales_before_returns double",
    )
    health = spark.createDataFrame(
        [(dt.date(2011, m, 1), 0.9, 0.25 * m, 0.1, 0.1) for m in (1, 2, 4)],
        "month date, identified_sales_coverage double, next_month_repeat_rate double, top10_share double, customer_hhi double",
    )
    stable = ops.latest_stable_retention(health, kpi).first()
    snap = ops.report_snapshot(kpi, health).first()
    assert (stable.month, stable.next_month_repeat_rate) == (snap.retention_month, snap.next_month_repeat_rate)
    assert snap.retention_month == dt.date(2011, 2, 1)
