"""Helpers shared by the text operators.

Operators that need code per document run it on Arrow batches
(``mapInArrow``), cut into slices of bounded text size, so a task holds a few
megabytes of text at a time however long the table is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.plans.materialize import drop_path, table_path, write_and_read

#: Text handled at once inside a task.
SLICE_BYTES = 8 << 20
#: White space of the word rule: space and U+0009 to U+000D.
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def slices(batch: pa.RecordBatch, text_col: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows with at most ``limit`` text bytes
    (a longer single row stays whole)."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = np.array([len(v) if v is not None else 0 for v in map(_buffer, batch.column(text_col))], dtype=np.int64)
    start, held = 0, 0
    for i in range(n):
        if i > start and held + sizes[i] > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += sizes[i]
    yield batch.slice(start, n - start)


def _buffer(value: pa.Scalar):
    return value.as_buffer() if value.is_valid else None


def map_documents(
    docs: DataFrame,
    fn: Callable[[dict], dict],
    schema: T.StructType,
    columns: list[str],
    text_col: str = "text",
) -> DataFrame:
    """Apply ``fn`` to slices of ``docs``: it takes {column: list} and gives
    {column: list or numpy array} in the columns of ``schema`` (any number of
    rows).  Only ``columns`` are read."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                got = fn({c: part.column(c).to_pylist() for c in columns})
                yield record_batch(got, out)

    return docs.select(*columns).mapInArrow(run, schema)


def record_batch(values: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values[f.name], type=f.type) for f in schema], schema=schema)


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def null_safe_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def held_out(col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """True where crc32 of the id's decimal text falls in the held-out fold."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def file_bytes(path: str) -> bytes:
    """A vocabulary file (a few megabytes), read on the driver and shipped to
    the tasks as a broadcast, so executors need no local copy."""
    with open(path, "rb") as f:
        return f.read()


def vocabulary(name: str) -> str:
    """Default place of a public tokenizer's file; operators take the path as
    a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (numpy, wrapping)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Kept(dict):
    """Values of ``compute`` by key, kept in two generations of ``size``: a
    full one becomes the old one, and keys met again move back from it, so
    frequent keys stay and memory is bounded.  Keys over ``longest`` are
    computed each time."""

    def __init__(self, compute: Callable, size: int, longest: int):
        super().__init__()
        self.compute, self.size, self.longest, self.old = compute, size, longest, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Scratch:
    """Intermediate tables that go as soon as what they led to is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(table_path(self.spark, name))
        return write_and_read(df, name, path=self.paths[-1])

    def drop(self) -> None:
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
