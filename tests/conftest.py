import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tillroll import schema as S  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import local_session

    s = local_session("*", shuffle_partitions=8, app="tillroll-tests")
    yield s


def line(
    inv="1", stock="P1", desc="THING", qty=1, date="2010-12-01", price=1.0, cust=1, country="UK"
):
    ts = dt.datetime.fromisoformat(date) if isinstance(date, str) else date
    return (inv, stock, desc, qty, ts, price, cust, country)


@pytest.fixture
def raw(spark):
    def make(rows):
        return spark.createDataFrame(rows, S.RAW_SCHEMA)

    return make


@pytest.fixture
def fact(raw):
    from tillroll.operators.clean import clean_lines

    def make(rows):
        return clean_lines(raw(rows))

    return make


def rows(df, *cols, order=None):
    df = df.select(*cols) if cols else df
    if order:
        df = df.orderBy(*order)
    return [tuple(r) for r in df.collect()]
