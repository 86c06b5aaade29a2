import os
import tempfile

from tillroll.operators.clean import clean_lines
from tillroll.sources.retail_lines import retail_lines
from tillroll.streaming import stream_fact_lines


def test_stream_ingest_matches_batch_cleaning(spark):
    base = tempfile.mkdtemp(prefix="tillroll-stream-")
    src, sink, ckpt = (os.path.join(base, n) for n in ("in", "out", "ckpt"))
    raw = retail_lines(spark, "/root/testdata/sf0.001")
    # Two drops of files, as they would land over time.
    raw.filter("CustomerID IS NULL OR CustomerID % 2 = 0").write.parquet(os.path.join(src, "a"))
    raw.filter("CustomerID % 2 = 1").write.parquet(os.path.join(src, "b"))
    q = stream_fact_lines(spark, os.path.join(src, "*"), sink, ckpt, fmt="parquet", trigger_available_now=True)
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    cols = [c for c in clean_lines(raw).columns]
    a = sorted(map(tuple, got.select(*cols).collect()), key=repr)
    b = sorted(map(tuple, clean_lines(raw).collect()), key=repr)
    assert a == b and len(a) > 5000


def test_stream_csv_ingest(spark):
    from test_sources import CSV

    base = tempfile.mkdtemp(prefix="tillroll-stream-csv-")
    src, sink, ckpt = (os.path.join(base, n) for n in ("in", "out", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "day1.csv"), "w") as fh:
        fh.write(CSV)
    q = stream_fact_lines(spark, src, sink, ckpt, fmt="csv", trigger_available_now=True, multiline=True)
    q.awaitTermination(120)
    got = {r.StockCode: r for r in spark.read.parquet(sink).collect()}
    # Null price, null invoice and 'nan' price lines are dropped by cleaning.
    assert set(got) == {"85123A", "D", "22633"}
    assert got["D"].type == "DISCOUNT" and got["85123A"].type == "PRODUCT"
    assert str(got["85123A"].month) == "2010-12-01"
