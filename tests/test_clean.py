import re

import pytest
from conftest import line, rows
from tillroll import schema as S


def test_t1_rule_order_and_normalisation(fact):
    data = [
        line(inv="1", stock="\tamazonfee ", desc="x"),
        line(inv="2", stock="cruk", desc="x"),
        line(inv="3", stock="P9", desc="bank charges adj"),
        line(inv="4", stock=" m", desc="x"),
        line(inv="5", stock="d　", desc="x"),
        line(inv="6", stock="P9", desc="dotcom postage"),
        line(inv="7", stock="P9", desc="free samples"),
        line(inv="\tc8", stock="P9", desc="mug", qty=2),
        line(inv="9", stock="P9", desc="mug"),
        line(inv="10", stock="P9", desc="amazon fee"),
        line(inv="11", stock="P9", desc="Cruk Commission"),
        line(inv="12", stock="P9", desc="user manual holder"),
        line(inv="13", stock="P9", desc="discount"),
    ]
    got = dict(rows(fact(data), S.INVOICE, S.TYPE))
    assert got == {
        "1": "FEE", "2": "FEE", "3": "BANK_CHARGE", "4": "MANUAL", "5": "DISCOUNT", "6": "POSTAGE",
        "7": "SAMPLES", "\tc8": "RETURN", "9": "PRODUCT", "10": "FEE", "11": "FEE", "12": "MANUAL",
        "13": "DISCOUNT",
    }


def test_t2_negative_postage_is_postage(fact):
    assert rows(fact([line(desc="POSTAGE", qty=-1)]), S.TYPE) == [("POSTAGE",)]


def test_t3_t4_returns(fact):
    got = rows(
        fact([line(inv="c1", qty=5, price=2.0), line(inv="1", qty=-5, price=2.0)]),
        S.INVOICE, S.TYPE, "return_value", "net_gmv", "is_return", "is_product", order=[S.INVOICE],
    )
    assert [(a, b, float(c), float(d), e, f) for a, b, c, d, e, f in got] == [
        ("1", "RETURN", -10.0, 0.0, True, False),
        ("c1", "RETURN", 10.0, 0.0, True, False),
    ]


def test_t5_zero_quantity_is_product(fact):
    from tillroll.operators.customer import customer_id_coverage

    f = fact([line(qty=0, price=3.0)])
    assert rows(f, S.TYPE, "net_gmv") == [("PRODUCT", 0)]
    cov = customer_id_coverage(f).collect()[0]
    assert cov.total_product_rows == 1 and cov.total_product_orders == 1


def test_t7_bad_prices_dropped(fact):
    data = [
        line(inv="1", price=0.0), line(inv="2", price=None), line(inv="3", price=float("nan")),
        line(inv="4", price=-1.0), line(inv="5", price=1.5), line(inv="6", stock=None),
        line(inv=None), line(inv="8", qty=None),
    ]
    assert rows(fact(data), S.INVOICE) == [("5",)]


def test_t8_null_date_survives_cleaning_not_months(fact):
    from tillroll.operators.kpi import monthly_kpis

    f = fact([line(inv="1", date=None), line(inv="2", date="2011-01-05")])
    assert f.count() == 2
    assert rows(monthly_kpis(f), "month", "order") == [(__import__("datetime").date(2011, 1, 1), 1)]


def test_flags_and_money(fact):
    r = fact([line(qty=3, price=1.1, desc="Discount")]).collect()[0]
    assert r.is_non_merch_adjustment and not r.is_product
    assert float(r.line_gmv) == 3.3 and float(r.net_gmv) == 0.0 and r.abs_quantity == 3
    assert str(r.month) == "2010-12-01" and str(r.order_date) == "2010-12-01"


def test_python_strip_set_matches_isspace():
    assert all(chr(c).isspace() for c in S.PY_WHITESPACE_CODEPOINTS)
    assert sum(1 for c in range(0x110000) if chr(c).isspace()) == len(S.PY_WHITESPACE)


def test_classification_random_against_python(fact):
    import random

    from test_bruteforce import _classify

    rnd = random.Random(11)
    ws = ["", " ", "\t", "　", "\xa0", " ", "\x1c", "\n"]
    parts = ["amazonfee", "AmazonFee", "cruk", "bank charges", "m", "M", "d", "D", "P12", "c", "C1", "mx"]
    words = ["amazon fee", "Cruk commission", "BANK CHARGES", "manual", "disCount", "postage", "samples",
             "mug", "cake", "", None]
    data, expected = [], {}
    for i in range(600):
        inv = rnd.choice(ws) + rnd.choice(["c", "C", "", "x"]) + str(i) + rnd.choice(ws)
        stock = rnd.choice(ws) + rnd.choice(parts) + rnd.choice(ws)
        desc = rnd.choice(words)
        if desc is not None and rnd.random() < 0.5:
            desc = "the " + desc + " item"
        qty = rnd.choice([-2, 0, 3])
        data.append(line(inv=inv, stock=stock, desc=desc, qty=qty))
        expected[inv] = _classify(inv, stock, desc, qty)
    got = dict(rows(fact(data), S.INVOICE, S.TYPE))
    assert got == expected


def test_small_prices_keep_their_digits(raw):
    from tillroll import operators as ops
    from tillroll.operators.clean import clean_lines

    lines = [line(inv="1", price=0.12345678, qty=3), line(inv="2", price=0.00004, qty=1)]
    kpi = ops.monthly_kpis(clean_lines(raw(lines))).first()
    assert abs(kpi.avg_unit_price - 0.06174839) < 1e-12 and abs(kpi.net_gmv - 0.37041034) < 1e-12
    four = clean_lines(raw(lines), money_scale=4)
    assert [str(r.net_gmv) for r in four.orderBy("InvoiceNo").collect()] == ["0.3705", "0.0001"]
    assert ops.monthly_kpis(four).first().avg_unit_price > 0


def test_large_prices_are_exact_and_infinite_ones_named(raw):
    from tillroll import operators as ops
    from tillroll.operators.clean import clean_lines

    lines = [line(inv="1", price=20_000_000_000.5, qty=3), line(inv="2", price=9_999_999_999.25, qty=-2),
             line(inv="3", price=123_456_789_012.125, qty=1_000), line(inv="4", price=2.5, qty=4)]
    got = {r.InvoiceNo: str(r.line_gmv) for r in clean_lines(raw(lines)).collect()}
    assert got == {"1": "60000000001.50000000", "2": "-19999999998.50000000",
                   "3": "123456789012125.00000000", "4": "10.00000000"}
    assert ops.monthly_kpis(clean_lines(raw([lines[0]]))).first().net_gmv == 60000000001.5
    for bad in (float("inf"), 1e20):
        with pytest.raises(Exception, match="price has too many digits"):
            clean_lines(raw([line(price=bad)])).collect()


def test_cleaning_is_one_method_that_java_compiles(spark, raw, tmp_path):
    from tillroll.operators.clean import clean_lines

    raw([line()]).write.parquet(str(tmp_path / "raw"))
    plan = clean_lines(spark.read.parquet(str(tmp_path / "raw")))._jdf.queryExecution()
    text = spark.sparkContext._jvm.PythonSQLUtils.explainString(plan, "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000  # HotSpot's limit for huge methods
