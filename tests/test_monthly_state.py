"""The incremental job: stored aggregates equal a full run, only new files are
read, and a stopped or repeated run changes nothing."""

import random

import pytest
from conftest import line

from tillroll import operators as ops
from tillroll import schema as S
from tillroll.operators.clean import clean_lines
from tillroll.plans.fact_store import _deal
from tillroll.plans.manifest import Conflict, Manifests
from tillroll.plans.monthly_state import MonthlyState, _bitmaps, _cell_sums
from tillroll.plans.pipeline import build_tables, drop_old_sets, publish_tables, read_published, run_pipeline
from tillroll.sources.retail_lines import retail_lines


def deliveries(seed=1, count=3, size=60):
    """Lines dealt to deliveries at random, so months overlap and lines come late."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        part = []
        for _ in range(size):
            part.append(line(
                inv=rng.choice(["", "", "", "C"]) + str(rng.randrange(40)),
                stock=rng.choice(["P1", "P2", "P3", "P4", "M"]),
                desc=rng.choice(["MUG", "CAKE", None]),
                qty=rng.choice([-2, 1, 2, 5]),
                date=rng.choice([f"2011-0{rng.randrange(1, 8)}-{rng.randrange(1, 29):02d}", None]),
                price=rng.choice([0.5, 1.25, 3.0]),
                cust=rng.choice([None, *range(1, 12)]),
            ))
        out.append(part)
    return out


def write(raw, rows, path):
    raw(rows).coalesce(1).write.mode("append").parquet(str(path))


def same(got, want):
    pick = lambda df: sorted(map(repr, (tuple(r) for r in df.select(sorted(df.columns)).collect())))
    assert pick(got) == pick(want)


@pytest.fixture
def reader(spark):
    seen = []

    def read(paths):
        seen.append(paths)
        return spark.read.parquet(*paths)

    read.seen = seen
    return read


def test_all_outputs_equal_a_full_run(spark, raw, reader, tmp_path):
    state = MonthlyState(spark, f"{tmp_path}/state")
    parts = deliveries()
    for rows in parts:
        write(raw, rows, tmp_path / "raw")
        assert state.add_files(str(tmp_path / "raw"), reader) == 1
        assert len(reader.seen[-1]) == 1  # only the new file
    assert state.add_files(str(tmp_path / "raw"), reader) == 0 and state.version == 3 and len(reader.seen) == 3
    fact = clean_lines(raw([r for p in parts for r in p]))
    full = build_tables(fact, cache_small=False)
    mine = state.tables()
    assert set(mine) == set(full)
    for name in ("kpi_monthly", "customer_health_monthly", "cohort_table", "top_return_skus", "report_snapshot",
                 "return_watchlist", "kpi_monthly_with_mom", "kpi_series_long"):
        same(mine[name], full[name])
    for freq in ("M", "Q", "Y"):
        same(state.cohort_table(freq), ops.cohort_table(fact, freq=freq))
    same(state.retention(), ops.retention(fact))
    same(state.customer_counts(), ops.product_month_core(fact).select("month", "customer").where("customer > 0"))

    state.compact()
    assert state.version == 4 and len(state.generations) == 1
    same(MonthlyState(spark, f"{tmp_path}/state").tables()["kpi_monthly"], full["kpi_monthly"])
    same(state.cohort_table("Q"), ops.cohort_table(fact, freq="Q"))
    same(state.retention(), ops.retention(fact))
    assert len(state.vacuum()) == 3 and state.vacuum() == []
    assert state.add_files(str(tmp_path / "raw"), reader) == 0


def test_late_line_moves_a_customer_to_an_earlier_cohort(spark, raw, reader, tmp_path):
    state = MonthlyState(spark, f"{tmp_path}/state")
    write(raw, [line(cust=1, date="2011-03-05"), line(cust=2, date="2011-03-05", inv="2")], tmp_path / "raw")
    state.add_files(str(tmp_path / "raw"), reader)
    write(raw, [line(cust=1, date="2011-01-05", inv="3")], tmp_path / "raw")
    state.add_files(str(tmp_path / "raw"), reader)
    got = {tuple(r) for r in state.cohort_table().collect()}
    assert got == {("2011-01", 0, 1), ("2011-01", 2, 1), ("2011-03", 0, 1)}


def test_numbers_are_dense_and_kept(spark, raw, reader, tmp_path):
    state = MonthlyState(spark, f"{tmp_path}/state")
    seen = {}
    for rows in deliveries(seed=2):
        write(raw, rows, tmp_path / "raw")
        state.add_files(str(tmp_path / "raw"), reader)
        now = {r[S.CUSTOMER]: r["number"] for r in state.table("numbers").collect()}
        assert sorted(now.values()) == list(range(1, len(now) + 1))
        assert all(now[c] == n for c, n in seen.items())
        seen = now


def test_retention_by_bitmaps_moves_no_customers(spark, raw, reader, tmp_path):
    state = MonthlyState(spark, f"{tmp_path}/state")
    write(raw, deliveries()[0], tmp_path / "raw")
    state.add_files(str(tmp_path / "raw"), reader)
    plan = state.retention()._jdf.queryExecution().optimizedPlan().toString()
    assert S.CUSTOMER not in plan


def test_stopped_and_competing_runs_change_nothing(spark, raw, reader, tmp_path):
    folder = f"{tmp_path}/state"
    state, other = MonthlyState(spark, folder), MonthlyState(spark, folder)
    write(raw, deliveries()[0], tmp_path / "raw")

    def broken(paths):
        return spark.read.parquet(*paths).selectExpr("*", "raise_error('stopped') as x").drop("x").where("x is null")

    with pytest.raises(Exception):
        state.add_files(str(tmp_path / "raw"), broken)
    assert state.version == 0 and state.table("files") is None
    assert [n for n in state.manifests.names() if n.startswith("gen-")] == []
    state.add_files(str(tmp_path / "raw"), reader)
    with pytest.raises(Conflict):
        other.add_files(str(tmp_path / "raw"), reader)
    assert MonthlyState(spark, folder).generations == state.generations
    assert len([n for n in state.manifests.names() if n.startswith("gen-")]) == 1
    with pytest.raises(ValueError, match="decimals"):
        MonthlyState(spark, folder, money_scale=4)


def test_changed_file_is_an_error(spark, raw, reader, tmp_path):
    state = MonthlyState(spark, f"{tmp_path}/state")
    write(raw, deliveries()[0], tmp_path / "raw")
    state.add_files(str(tmp_path / "raw"), reader)
    file = next((tmp_path / "raw").glob("part-*.parquet"))
    raw(deliveries(seed=9)[0][:5]).coalesce(1).write.parquet(f"{tmp_path}/x")
    file.write_bytes(next((tmp_path / "x").glob("part-*.parquet")).read_bytes())
    crc = file.with_name(f".{file.name}.crc")
    crc.unlink(missing_ok=True)
    with pytest.raises(ValueError, match="has changed"):
        state.add_files(str(tmp_path / "raw"), reader)
    with pytest.raises(ValueError, match="no files"):
        MonthlyState(spark, f"{tmp_path}/none").tables()


def test_tables_are_published_together(spark, raw, tmp_path):
    out = f"{tmp_path}/out"
    first = raw(deliveries(seed=3)[0])
    run_pipeline(first, out_dir=out, versioned=True, read_back=False)
    before = read_published(spark, out)
    want = build_tables(clean_lines(first), cache_small=False)
    same(before["kpi_monthly"], want["kpi_monthly"])
    tables = build_tables(clean_lines(raw(deliveries(seed=4)[0])), cache_small=False)
    tables["dim_month"] = tables["dim_month"].selectExpr("*", "assert_true(false)")
    with pytest.raises(Exception):  # stopped between two tables
        publish_tables(spark, tables, out)
    for name, df in read_published(spark, out).items():
        same(df, before[name])
    again = build_tables(clean_lines(raw(deliveries(seed=4)[0])), cache_small=False)
    assert publish_tables(spark, again, out, "csv") == 2
    same(read_published(spark, out)["kpi_monthly"], again["kpi_monthly"])
    assert len(drop_old_sets(spark, out)) == 1
    same(read_published(spark, out)["cohort_table"], again["cohort_table"])


def test_torn_manifest_is_skipped(spark, tmp_path):
    m = Manifests(spark, f"{tmp_path}/m")
    assert m.latest() == (0, {})
    assert m.commit(0, {"a": 1}) == 1
    (tmp_path / "m" / "v000000002.json").write_text('{"a": ')
    assert m.latest() == (1, {"a": 1})
    assert m.commit(1, {"a": 3}) == 3
    assert m.latest() == (3, {"a": 3})
    with pytest.raises(Conflict):
        m.commit(1, {"a": 4})


def test_numbers_move_and_no_bitmap_of_a_task(spark):
    pairs = spark.range(100).selectExpr("add_months(date'2011-01-01', int(id % 2)) month", "id CustomerID")
    plan = _bitmaps(pairs, spark.range(100).selectExpr("id CustomerID", "id + 1 number"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_bitmap_construct_agg") < text.index("Exchange hashpartitioning(month")
    assert plan.selectExpr("sum(bitmap_count(bitmap))").first()[0] == 100


def test_cohort_cells_of_late_lines_in_one_pass(spark):
    new = spark.sql("values (1, date'2010-11-01'), (2, date'2011-02-01'), (2, date'2011-03-01')")
    old = spark.sql("values (1, date'2010-12-01'), (1, date'2011-01-01'), (2, date'2011-02-01')")
    rows = [df.toDF("CustomerID", "month").selectExpr("*", f"{o} _old") for df, o in ((new, "false"), (old, "true"))]
    cells = _cell_sums(rows[0].unionByName(rows[1]))
    text = cells._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(CustomerID") == 1
    got = {(f, str(c), str(p)): n for f, c, p, n in cells.collect()}
    # Customer 1 began a month earlier than known; customer 2 came again in March.
    assert got == {
        ("M", "2010-11-01", "2010-11-01"): 1, ("M", "2010-11-01", "2010-12-01"): 1, ("M", "2010-11-01", "2011-01-01"): 1,
        ("M", "2010-12-01", "2010-12-01"): -1, ("M", "2010-12-01", "2011-01-01"): -1, ("M", "2011-02-01", "2011-03-01"): 1,
    }


def test_deliveries_are_written_without_a_sort(spark, raw, tmp_path):
    rows = [line(inv=str(i), stock=f"P{i:04d}") for i in range(200)]
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    _deal(spark, raw(rows).coalesce(1), str(tmp_path / "raw"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    parts = [[r[0] for r in spark.read.parquet(f"{tmp_path}/raw/delivery={k}").select(S.STOCK).collect()] for k in (0, 1)]
    assert all(parts) and sorted(parts[0] + parts[1]) == [r[1] for r in rows] and all(p == sorted(p) for p in parts)


def test_lines_come_out_by_order_key(spark):
    plan = retail_lines(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin [l_orderkey") < plan.index("Join [l_partkey")
