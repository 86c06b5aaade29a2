import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll import operators as ops
from tillroll.operators import ranking
from tillroll.operators.ranking import rank_all, rank_by_value, top_by_value


def ranked(rows, order):
    """(row, rank) of each row within its first column, in plain Python."""
    out, seen = [], {}
    for r in sorted(rows, key=order):
        seen[r[0]] = seen.get(r[0], 0) + 1
        out.append((*r, seen[r[0]]))
    return sorted(out)


def by_value(r):
    return (r[0], -r[2], r[1])


def test_rank_equals_model(spark):
    data = {(dt.date(2011, 1 + i % 3, 1), f"S{i % 97:03d}"): float((i * 37) % 11) for i in range(3000)}
    rows = [(m, s, g) for (m, s), g in data.items()]
    df = spark.createDataFrame(rows, "month date, sku string, g double")
    got = rank_all(df, ["month"], [F.desc("g"), F.asc("sku")])
    assert sorted(map(tuple, got.collect())) == ranked(rows, by_value)


def test_rank_on_test_tables(spark):
    from tillroll.operators.clean import clean_lines
    from tillroll.sources.retail_lines import retail_lines

    f = clean_lines(retail_lines(spark, "/root/testdata/sf0.001"))
    got = sorted(map(tuple, ops.sku_month_rank(f).collect()))
    assert got == ranked([r[:3] for r in got], by_value) and len(got) > 1000


def test_rank_plans_run_no_counting_job():
    import inspect

    from tillroll.operators import ranking

    assert ".first()" not in inspect.getsource(ranking)


@pytest.mark.parametrize("n", [1, 2, 5, 2000])
def test_top_n_is_one_plan_for_every_n(spark, n):
    rows = [(i % 3, f"k{i}", float(i % 7)) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, id string, v double")
    out = ops.top_n(df, ["k"], [F.desc("v"), F.asc("id")], n)
    assert sorted(map(tuple, out.collect())) == [r for r in ranked(rows, by_value) if r[-1] <= n]
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Window [row_number") == 2
    if n <= 1000:  # a partial cut before each of the two shuffles
        assert plan.count("WindowGroupLimit") >= 2


def test_rank_with_one_hot_group(spark):
    # One month holds ~95% of the rows: its rank sequence spans many slices.
    hot = [(dt.date(2011, 1, 1), f"S{i:05d}", float(i % 50)) for i in range(4000)]
    cold = [(dt.date(2011, 2 + i % 3, 1), f"S{i:05d}", float(i)) for i in range(200)]
    df = spark.createDataFrame(hot + cold, "month date, sku string, g double").repartition(13)
    got = rank_all(df, ["month"], [F.desc("g"), F.asc("sku")], num_partitions=8)
    assert sorted(map(tuple, got.collect())) == ranked(hot + cold, by_value)


def value_rows(seed):
    """A hot month, values that a third of it shares, keys with a long common
    prefix, negative, zero and very close values."""
    import random

    rng = random.Random(seed)
    rows, months = {}, [dt.date(2011, 1, 1)] * 9 + [dt.date(2011, 2, 1), dt.date(2011, 3, 1)]
    for i in range(3000):
        month = rng.choice(months)
        v = rng.choice([7.25, 7.25, 0.0, -0.0, rng.random() * 1e6, rng.randrange(20) / 4, -3.5, 1e15 + rng.randrange(3)])
        rows[month, f"LONGPREFIX-{rng.randrange(10**6):07d}{rng.choice(['', 'é', '漢', 'Z'])}"] = v
    return [(m, k, v) for (m, k), v in rows.items()]


@pytest.mark.parametrize("slices,seed", [(256, 1), (16, 2), (4, 3)])
def test_rank_by_value_equals_model(spark, monkeypatch, slices, seed):
    monkeypatch.setattr(ranking, "VALUE_SLICES", slices)
    rows = value_rows(seed)
    df = spark.createDataFrame(rows, "month date, sku string, g double")
    want = ranked(rows, lambda r: (r[0], -r[2], r[1].encode()))
    assert sorted(map(tuple, rank_by_value(df, ["month"], "g", "sku").collect())) == want
    for limit in (1, 10, 700, 10**6):
        got = rank_by_value(df, ["month"], "g", "sku", limit=limit)
        assert sorted(map(tuple, got.collect())) == [r for r in want if r[-1] <= limit]
    number = [(m, int(k[11:18]), v) for m, k, v in rows if k[-1].isdigit()]
    df = spark.createDataFrame(number, "month date, sku long, g double")
    assert sorted(map(tuple, rank_by_value(df, ["month"], "g", "sku").collect())) == ranked(number, by_value)


def test_rank_by_value_of_decimals_and_nothing(spark):
    df = spark.range(500).selectExpr("1 as m", "id", "cast(1e20 + id % 9 / 1e7 as decimal(38,8)) + cast(id % 7 as decimal(20,8)) / 10000000 as v")
    rows = [(r.m, r.id, r.v) for r in df.collect()]
    assert sorted(map(tuple, rank_by_value(df, ["m"], "v", "id").select("m", "id", "v", "rank").collect())) == ranked(rows, by_value)
    assert rank_by_value(df.where("id < 0"), ["m"], "v", "id").count() == 0


def test_ranks_run_no_job_before_the_action(spark, fact):
    from conftest import line

    lines = fact([line(inv=str(i), stock=f"P{i % 9}", cust=i % 5) for i in range(60)])
    sc = spark.sparkContext
    sc.setJobGroup("ranks", "plans only")
    try:
        plans = [ops.sku_month_rank(lines), ops.customer_month_rank(lines), ops.topn_coverage(lines, n=10**6)]
        assert list(sc.statusTracker().getJobIdsForGroup("ranks")) == []
        assert [df.count() for df in plans] == [9, 5, 1]
        assert list(sc.statusTracker().getJobIdsForGroup("ranks"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_top_of_a_hot_group_is_spread(spark):
    """A million of one month: no task ranks more than a few slices' rows."""
    df = spark.range(1_200_000).selectExpr("'m' as month", "id", "cast(hash(id) % 100000 as double) as v")
    out = top_by_value(df, ["month"], "v", "id", 1_000_000)
    counts = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in counts) == 1_000_000
    assert max(r["count"] for r in counts) < 400_000
    assert out.where("rank = 1000000").count() == 1
