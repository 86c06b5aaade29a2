import datetime as dt
import os
import random
import tempfile

import pytest
from conftest import rows

from tillroll import schema as S
from tillroll.sources.csv import BROKEN, load_csv, read_text_lines, rejected_lines, with_options
from tillroll.sources.csv_split import _lines, split_states, state_after
from tillroll.sources.sinks import read_table_back, save_table

CSV = (
    'InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n'
    '536365,85123A,WHITE HANGING HEART T-LIGHT HOLDER,6,12/1/2010 8:26,2.55,17850.0,United Kingdom\n'
    'C536379,D,Discount,-1,12/1/2010 9:41,27.5,14527,United Kingdom\n'
    '536366,22633,"HAND WARMER, ""UNION"" JACK\nSECOND LINE ",6,12/1/2010 8:28,1.85,NA,United Kingdom\n'
    '536367,22745,NULL,8,12/1/2010 8:34,nan,,France\n'
    'N/A,22748,None,6,,2.1,13047,<NA>\n'
)


def test_csv_reader_types_quotes_and_null_tokens(spark):
    d = tempfile.mkdtemp(prefix="tillroll-csv-")
    p = os.path.join(d, "retail.csv")
    with open(p, "w") as fh:
        fh.write(CSV)
    df = load_csv(spark, p, multiline=True)
    assert [f.dataType.simpleString() for f in df.schema.fields] == [
        "string", "string", "string", "bigint", "timestamp_ntz", "double", "bigint", "string"]
    got = {r[1]: r for r in rows(df)}
    assert got["85123A"] == ("536365", "85123A", "WHITE HANGING HEART T-LIGHT HOLDER", 6,
                             dt.datetime(2010, 12, 1, 8, 26), 2.55, 17850, "United Kingdom")
    assert got["22633"][2] == 'HAND WARMER, "UNION" JACK\nSECOND LINE ' and got["22633"][6] is None
    assert got["22745"][2] is None and got["22745"][5] is None and got["22745"][6] is None
    assert got["22748"][0] is None and got["22748"][2] is None and got["22748"][4] is None
    assert got["22748"][7] is None
    assert got["D"][0] == "C536379" and got["D"][3] == -1
    assert len(got) == 5


HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"


def csv_file(*lines, header=HEADER):
    p = os.path.join(tempfile.mkdtemp(prefix="tillroll-csv-"), "x.csv")
    with open(p, "w") as fh:
        fh.write("\n".join([header, *lines]) + "\n")
    return p


def test_csv_columns_by_name(spark):
    p = csv_file("7,85123A,536365,WHITE,France,17850,2.55,6,12/1/2010 8:26",
                 header="Id,StockCode,InvoiceNo,Description,Country,CustomerID,UnitPrice,Quantity,InvoiceDate")
    assert rows(load_csv(spark, p)) == [
        ("536365", "85123A", "WHITE", 6, dt.datetime(2010, 12, 1, 8, 26), 2.55, 17850, "France")]
    with pytest.raises(ValueError, match="UnitPrice"):
        load_csv(spark, csv_file("1,2", header="InvoiceNo,StockCode,Description,Quantity,InvoiceDate,CustomerID,Country"))


def test_csv_files_of_one_folder_must_agree(spark):
    p = csv_file("1,A,x,1,12/1/2010 8:26,1.0,,UK")
    with open(os.path.join(os.path.dirname(p), "y.csv"), "w") as fh:
        fh.write("StockCode,InvoiceNo,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\nA,1,x,1,,1.0,,UK\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_csv(spark, os.path.dirname(p)).collect()


def test_csv_dates_and_large_ids(spark):
    forms = {"12/1/2010 8:26": (8, 26, 0), "12/1/2010 8:26:30": (8, 26, 30), "2010-12-01T08:26:00": (8, 26, 0),
             "2010-12-01 08:26:05": (8, 26, 5), "2010-12-01": (0, 0, 0)}
    p = csv_file(*[f"1,A{i},x,{i + 1}.0,{d},1.5,{2**53 + i},UK" for i, d in enumerate(forms)])
    got = {r[1]: r for r in rows(load_csv(spark, p))}
    for i, time in enumerate(forms.values()):
        assert got[f"A{i}"][3:7] == (i + 1, dt.datetime(2010, 12, 1, *time), 1.5, 2**53 + i)


@pytest.mark.parametrize("line,column", [
    ("1,A,x,2.5,12/1/2010 8:26,1.0,,UK", "Quantity"), ("1,A,x,2,first of May,1.0,,UK", "InvoiceDate"),
    ("1,A,x,2,12/1/2010 8:26,cheap,,UK", "UnitPrice"), ("1,A,x,2,12/1/2010 8:26,1.0,17a,UK", "CustomerID"),
    ("1,A,x,2", "row"), ('1,A,"x', "row"),
])
def test_csv_bad_lines_are_told_or_counted(spark, line, column):
    p = csv_file("536365,85123A,WHITE,6,12/1/2010 8:26,2.55,17850,UK", line)
    with pytest.raises(Exception, match="bad CSV line, column " + column):
        load_csv(spark, p).collect()
    kept = load_csv(spark, p, on_bad="reject")
    assert [r[0] for r in rows(kept)] == ["536365"]
    assert rows(rejected_lines(spark, p)) == [(column, 1)]


def test_save_table_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="tillroll-sink-")
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    save_table(df, f"{d}/p", sort_by=["k"])
    save_table(df, f"{d}/c", fmt="csv")
    assert sorted(map(tuple, spark.read.parquet(f"{d}/p").collect())) == [(1, "a"), (2, "b")]
    assert spark.read.option("header", True).csv(f"{d}/c").count() == 2


def test_cli_job_and_read_back(spark):
    import datetime as dt

    from tillroll.__main__ import main
    from tillroll.sources.sinks import read_table_back

    d = tempfile.mkdtemp(prefix="tillroll-cli-")
    p = os.path.join(d, "retail.csv")
    with open(p, "w") as fh:
        fh.write(CSV)
        fh.write("536370,22728,ALARM CLOCK BAKELIKE PINK,24,1/4/2011 8:45,3.75,12583,France\n")
    main(["--csv", p, "--csv-multiline", "--out", f"{d}/out", "--out-format", "csv"])
    kpi = read_table_back(spark, f"{d}/out/kpi_monthly", fmt="csv")
    got = sorted((r.month, r.is_partial_month) for r in kpi.collect())
    assert got == [(dt.date(2010, 12, 1), False), (dt.date(2011, 1, 1), True)]
    assert read_table_back(spark, f"{d}/out/report_snapshot", fmt="csv").count() == 1


def test_size_shuffles_only_raises(spark):
    from tillroll.session import input_bytes, size_shuffles

    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    n = input_bytes(df)
    assert n == os.path.getsize("/root/testdata/sf0.01/lineitem.parquet")
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert size_shuffles(spark, n) == before  # small input: unchanged
    try:
        assert size_shuffles(spark, 100 << 40) == 409_600  # 100 TiB in 256 MiB pieces
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))


def test_input_bytes_of_derived_frames(spark):
    from tillroll.session import input_bytes

    p = "/root/testdata/sf0.01/{}.parquet"
    a, b = (spark.read.parquet(p.format(t)) for t in ("lineitem", "orders"))
    joined = a.join(b, a.l_orderkey == b.o_orderkey).where("l_quantity > 5")
    assert input_bytes(joined) == sum(os.path.getsize(p.format(t)) for t in ("lineitem", "orders"))
    assert input_bytes(spark.range(5)) == 0


def test_published_csv_files(spark):
    """Written CSVs carry months as text under the published header, and
    report frames built on them equal the direct ones."""
    import glob

    from tillroll import operators as ops
    from tillroll.plans.pipeline import run_pipeline
    from tillroll.sources.retail_lines import retail_lines
    from tillroll.sources.sinks import read_table_back

    d = tempfile.mkdtemp(prefix="tillroll-csvout-")
    out = run_pipeline(retail_lines(spark, "/root/testdata/sf0.001"), out_dir=d, fmt="csv")

    def text(name):
        (path,) = glob.glob(f"{d}/{name}/*.csv")
        with open(path) as fh:
            return fh.read().splitlines()

    kpi = text("kpi_monthly")
    assert kpi[0].startswith("month,net_gmv,order,customer,unit_sold,avg_unit_price,active_order_days,return_value")
    months = [x.split(",")[0] for x in kpi[1:]]
    assert months == sorted(months) and all(len(m) == 7 and m[4] == "-" for m in months)
    assert text("dim_month")[1].split(",")[:1] == [months[0]] and months[0] + "-01" in text("dim_month")[1]
    burdens = [float(x.split(",")[-4]) for x in text("return_watchlist")[1:]]
    assert burdens == sorted(burdens)
    back = {n: read_table_back(spark, f"{d}/{n}", fmt="csv") for n in out}
    direct = run_pipeline(retail_lines(spark, "/root/testdata/sf0.001"))
    for frame in (
        lambda t: ops.return_watchlist(t["top_return_skus"], t["kpi_monthly"]),
        lambda t: ops.report_snapshot(t["kpi_monthly"], t["customer_health_monthly"]),
        lambda t: ops.latest_stable_retention(t["customer_health_monthly"], t["kpi_monthly"]),
    ):
        a, b = frame(back), frame(direct)
        assert a.dtypes == b.dtypes and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_read_back_sorts_numbers_as_numbers(spark):
    d = tempfile.mkdtemp(prefix="tillroll-num-")
    rows = [("2011-01", f"S{i}", "x", b, 1, i) for i, b in enumerate([3.0, 9.0, 80.0, 400.0, 700.0, 6000.0, 50000.0])]
    cols = "month string, StockCode string, Description string, return_burden double, return_units long, rank long"
    spark.createDataFrame(rows, cols).coalesce(1).write.option("header", True).csv(f"{d}/top")
    from tillroll import operators as ops
    from tillroll.sources.sinks import read_table_back

    kpi = spark.createDataFrame([(dt.date(2011, 1, 1), False)], "month date, is_partial_month boolean")
    got = ops.return_watchlist(read_table_back(spark, f"{d}/top", fmt="csv"), kpi)
    assert sorted(r.return_burden for r in got.collect()) == [80.0, 400.0, 700.0, 6000.0, 50000.0]


def test_fact_store_sees_nested_files(spark):
    import shutil

    from tillroll.plans.fact_store import fact_lines

    d = tempfile.mkdtemp(prefix="tillroll-nested-")
    for t in ("orders", "part", "customer", "nation"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", d)
    os.makedirs(f"{d}/lineitem.parquet/p=1")
    shutil.copy("/root/testdata/sf0.001/lineitem.parquet", f"{d}/lineitem.parquet/p=1/a.parquet")
    n = fact_lines(spark, d).count()
    shutil.copy("/root/testdata/sf0.001/lineitem.parquet", f"{d}/lineitem.parquet/p=1/b.parquet")
    assert fact_lines(spark, d).count() == 2 * n > 0


def test_failed_job_leaves_no_folder(spark):
    import glob

    from tillroll.plans.materialize import checkpoint_dir
    from tillroll.plans.pipeline import run_pipeline
    from tillroll.sources.retail_lines import retail_lines

    root = checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{root}/tables/*"))
    with pytest.raises(ValueError):
        run_pipeline(retail_lines(spark, "/root/testdata/sf0.001"), out_dir=tempfile.mkdtemp(), fmt="xml")
    assert set(glob.glob(f"{root}/tables/*")) == before


def test_pipeline_cleans_up_intermediate(spark):
    import glob

    from tillroll.plans.materialize import checkpoint_dir
    from tillroll.plans.pipeline import PUBLISHED, REPORT, run_pipeline
    from tillroll.sources.retail_lines import retail_lines

    root = checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{root}/tables/fact_lines-*"))
    d = tempfile.mkdtemp(prefix="tillroll-job-")
    out = run_pipeline(retail_lines(spark, "/root/testdata/sf0.001"), out_dir=d)
    assert set(out) == set(PUBLISHED) | set(REPORT)
    assert set(glob.glob(f"{root}/tables/fact_lines-*")) == before
    assert out["kpi_monthly"].count() == spark.read.parquet(f"{d}/kpi_monthly").count() > 0


def test_cli_on_raw_parquet(spark):
    from tillroll.__main__ import main
    from tillroll.sources.retail_lines import retail_lines

    d = tempfile.mkdtemp(prefix="tillroll-cli-pq-")
    retail_lines(spark, "/root/testdata/sf0.001").write.parquet(f"{d}/raw")
    main(["--parquet", f"{d}/raw", "--out", f"{d}/out", "--cohort-freq", "Y", "--concentration-n", "5"])
    conc = spark.read.parquet(f"{d}/out/customer_concentration")
    assert "top5_share" in conc.columns and conc.count() > 0
    assert spark.read.parquet(f"{d}/out/cohort_table").filter("length(cohort_month) = 4").count() > 0
    assert spark.read.parquet(f"{d}/out/report_snapshot").columns[8] == "top5_share"


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def splits(spark):
    yield lambda size: small_splits(spark, size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted_rows(seed, count):
    """Rows with newlines, quotes and commas in quoted descriptions, and plain
    quotes inside unquoted ones."""
    rng = random.Random(seed)
    out = []
    for i in range(count):
        words = [rng.choice(["MUG", "two\nlines", '5"" PIPE', "a,b", "\n\n", '""', "\n", "\r\n x"]) for _ in range(rng.randrange(4))]
        desc = f'"{" ".join(words)}"' if rng.random() < 0.7 else rng.choice(["PLAIN", '5" PIPE', 'A "B" C', ""])
        out.append(f"{i},S{i % 7},{desc},{rng.randrange(9)},12/1/2010 8:26,2.55,17850,UK")
    return out


@pytest.mark.parametrize("size,seed", [(37, 1), (61, 2), (200, 3), (1 << 20, 4)])
def test_quoted_newlines_in_many_tasks_equal_the_whole_file_read(spark, splits, size, seed):
    d = tempfile.mkdtemp(prefix="tillroll-csv-")
    end = "\r\n" if seed == 3 else "\n"
    for k in range(3):
        with open(os.path.join(d, f"{k}.csv"), "w", newline="") as fh:
            lines = [HEADER, *quoted_rows(10 * seed + k, 40 if k else 0)]
            fh.write(end.join(lines) + (end if k != 1 else ""))
    whole = with_options(spark.read, HEADER.split(","), True).csv(d).drop(BROKEN).collect()
    splits(size)
    text = read_text_lines(spark, d, multiline=True)
    if size < 1000:
        assert len(split_states(_lines(spark, d))) > 20
    got = text.drop(BROKEN).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, whole)) and len(got) == 80
    assert load_csv(spark, d, multiline=True).count() == 80


@pytest.mark.parametrize("line,begun,ends", [
    ("a,b", 0, 0), ("a,b", 1, 1), ('a,"b', 0, 1), ('b"', 1, 0), ('"a""', 0, 1), ('"a"""', 0, 0), ('5" x,y', 0, 0),
    ('b",c,"d', 1, 1), ('b"",c', 1, 1), ('"', 0, 1), ('"', 1, 0), ('""', 0, 0), ('""', 1, 1), ('x,""', 0, 0),
    ('a"b,"c"d,"', 0, 1), ('"a"b"c,d', 0, 0), ('b",', 1, 0), ('b","', 1, 1),
])
def test_state_after_a_line(line, begun, ends):
    assert state_after(line, begun) == ends


def test_split_read_checks_headers_and_broken_rows(spark, splits):
    d = tempfile.mkdtemp(prefix="tillroll-csv-")
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write(HEADER + '\n1,S,"two\nlines",1,12/1/2010,2.5,1,UK\n2,S,x,1\n3,S,"open,1,12/1/2010,2.5,1,UK\n')
    splits(30)
    assert rejected_lines(spark, d, multiline=True).collect() == [("row", 2)]
    assert [r.InvoiceNo for r in load_csv(spark, d, multiline=True, on_bad="reject").collect()] == ["1"]
    with open(os.path.join(d, "b.csv"), "w") as fh:
        fh.write(HEADER.replace("Country", "Land") + "\n1,S,x,1,12/1/2010,2.5,1,UK\n")
    with pytest.raises(Exception, match="header"):
        load_csv(spark, d, multiline=True).collect()


def test_csv_twelve_hour_and_utc_dates_and_infinite_prices(spark):
    dates = ["12/1/2010 8:26 PM", "12/1/2010 12:05:30 am", "2010-12-01T08:26:00Z", "2010-12-01 08:26:00 Z", "2010-12-1 1:00 pm"]
    p = csv_file(*[f"{i},S,D,1,{d},2.5,1,UK" for i, d in enumerate(dates)])
    day = dt.datetime(2010, 12, 1)
    assert [r[4] - day for r in rows(load_csv(spark, p), order=["InvoiceNo"])] == [
        dt.timedelta(hours=h, minutes=m, seconds=s)
        for h, m, s in [(20, 26, 0), (0, 5, 30), (8, 26, 0), (8, 26, 0), (13, 0, 0)]]
    p = csv_file("1,S,D,1,12/1/2010,inf,1,UK", "2,S,D,1,12/1/2010,20000000000,1,UK", "3,S,D,1,12/1/2010,-Infinity,1,UK")
    assert rejected_lines(spark, p).collect() == [("UnitPrice", 2)]
    assert [r.UnitPrice for r in load_csv(spark, p, on_bad="reject").collect()] == [2e10]


def test_whole_numbers_are_read_back_exactly(spark):
    d = tempfile.mkdtemp(prefix="tillroll-back-")
    df = spark.sql("select date'2010-12-01' as month, 9007199254740993 as unit_sold, 7 as year")
    save_table(df, d + "/t", "csv")
    got = read_table_back(spark, d + "/t", "csv").first()
    assert (got.unit_sold, got.year) == (9007199254740993, 7)
    with open(os.path.join(d, "f.csv"), "w") as fh:
        fh.write("month,order\n2010-12,884.0\n")
    assert read_table_back(spark, d + "/f.csv", "csv").first().order == 884
