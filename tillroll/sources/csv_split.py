"""CSV records with newlines inside quoted fields, read in many tasks.

Spark's ``multiLine`` reader gives a file to one task, because a newline may
stand inside a quoted field and a split in the middle of a file cannot tell.
Here the file is read as plain lines in its ordinary splits, twice:

1. A line can begin outside or inside a quoted field.  For each split a task
   follows both cases through its lines and reports where each one ends: a
   function on two states, one row per split.  Composed in file order (a
   prefix scan) they tell in which state every split begins.
2. Each split then joins its lines to records.  What belongs to a record that
   began in an earlier split (its first lines) or goes on in a later one (its
   last lines) is put together by file and place: two short texts a split.

A file whose first line ends with ``\r\n`` has that line end everywhere; inside
fields it becomes a plain newline, as in the ordinary reader.

Lines without a quote leave the state as it is, so most cost one substring
count.  Quotes open a field only at its beginning and are doubled inside, as
the ordinary reader takes them; ``5" PIPE`` in an unquoted field is plain text.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OUT, IN = 0, 1
#: A line that, begun outside, ends inside a quoted field: whole fields, then
#: a quote that opens one and is not closed.
_OPENS = re.compile(r'(?:(?:"(?:[^"]|"")*"(?!")[^,]*|(?!")[^,]*),)*+"(?:[^"]|"")*+\Z')
#: The rest of a quoted field up to the comma after it.
_CLOSES = re.compile(r'(?:[^"]|"")*+"[^,]*')


def state_after(line: str, state: int) -> int:
    """Whether the line end stands outside or inside a quoted field."""
    if '"' not in line:
        return state
    at = 0
    if state == IN:
        closed = _CLOSES.match(line)
        if closed is None:
            return IN
        at = closed.end() + 1  # past the comma
        if at > len(line):
            return OUT
    return IN if _OPENS.match(line, at) else OUT


def _lines(spark: SparkSession, path) -> DataFrame:
    """(file, place, value): lines as they stand, with the split they are in."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("place"), "value"
    )


def _split_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array, list | None]]:
    """((file, place), lines, True where a line holds a quote or None) of each
    stretch of a batch; a split's lines come in order, one after the other."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, place, value = batch.column("file"), batch.column("place"), batch.column("value")
        keys = list(zip(pc.dictionary_encode(file).indices.to_pylist(), place.to_pylist()))
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                part = value.slice(start, i - start)
                quoted = pc.match_substring(part, '"')
                some = quoted.to_pylist() if pc.any(quoted).as_py() else None
                yield (file[start].as_py(), place[start].as_py()), part, some
                start = i


def split_states(lines: DataFrame) -> dict[tuple[str, int], tuple[int, bool]]:
    """(state in which the split begins, whether the file's lines end with
    ``\\r\\n``) by (file, place).  One row per split comes to the driver."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list] = {}
        for key, part, quoted in _split_lines(batches):
            if key not in found:
                found[key] = [OUT, IN, part[0].as_py().endswith("\r")]
            ends = found[key]
            if quoted is None:
                continue
            for line, some in zip(part.to_pylist(), quoted):
                if some:
                    same = ends[0] == ends[1]
                    ends[0] = state_after(line, ends[0])
                    ends[1] = ends[0] if same else state_after(line, ends[1])
        yield pa.RecordBatch.from_pydict(
            {
                "file": pa.array([k[0] for k in found], pa.string()),
                "place": pa.array([k[1] for k in found], pa.int64()),
                "from_out": pa.array([v[0] for v in found.values()], pa.int32()),
                "from_in": pa.array([v[1] for v in found.values()], pa.int32()),
                "crlf": pa.array([v[2] for v in found.values()], pa.bool_()),
            }
        )

    rows = lines.mapInArrow(follow, "file string, place long, from_out int, from_in int, crlf boolean").collect()
    begins, state, last, crlf = {}, OUT, None, False
    for r in sorted(rows):
        if r.file != last:  # its first split
            state, crlf = OUT, r.crlf
        begins[r.file, r.place] = (state, crlf)
        state, last = (r.from_in if state == IN else r.from_out), r.file
    return begins


def quoted_records(spark: SparkSession, path, header: list[str] | None = None) -> DataFrame:
    """(record): the records of the CSV files without their headers.  With
    ``header`` a file with other column names is an error."""
    lines = _lines(spark, path)
    begins = spark.sparkContext.broadcast(split_states(lines))
    schema = "record string, file string, place long, part int"
    # part: 0 whole record, 1 goes on a record of an earlier split, 2 begins a
    # record that goes on, 3 both (the split lies within one field)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, crlf, held, first, fresh = None, OUT, False, [], False, False

        def rows(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[], [], [], []]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names=["record", "file", "place", "part"]
            )

        def close() -> list[tuple]:
            """The lines held when the split ends inside a field."""
            return [("\n".join(held), *key, 3 if first else 2)] if held else []

        for now, part, quoted in _split_lines(batches):
            out = []
            if now != key:
                out += close()
                key, held = now, []
                if key not in begins.value:
                    raise ValueError(f"{key[0]} has changed while it was read")
                state, crlf = begins.value[key]
                first = state == IN  # the first lines go on an earlier record
                fresh = key[1] == 0  # the header is still to come
            for line, some in zip(part.to_pylist(), quoted or [False] * len(part)):
                if crlf:
                    line = line.removesuffix("\r")
                if fresh and not held:
                    line = line.removeprefix("﻿")
                after = state_after(line, state) if some else state
                if after == IN or held or first:
                    held.append(line)
                    if after == IN:
                        state = after
                        continue
                    line, held = "\n".join(held), []
                state = after
                if first:
                    out.append((line, *key, 1))
                    first = False
                    continue
                if fresh:
                    fresh = False
                    names = next(csv.reader([line])) if "\n" not in line else next(csv.reader(line.splitlines(True)))
                    if header is not None and names != header:
                        raise ValueError(f"{key[0]}: header {names} differs from {header}")
                elif line:
                    out.append((line, *key, 0))
            if out:
                yield rows(out)
        yield rows(close() if key else [])

    found = lines.mapInArrow(join, schema)
    # Pieces at split borders: a record begins at part 2 and ends at part 1.
    pieces = found.where("part > 0")
    order = Window.partitionBy("file").orderBy("place", F.col("part") == 2)
    numbered = pieces.withColumn("number", F.sum((F.col("part") == 2).cast("int")).over(order))
    stitched = numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("place", (F.col("part") == 2).alias("later"), "record"))).alias("all")
    )
    whole = stitched.select(F.concat_ws("\n", F.col("all.record")).alias("record"))
    return found.where("part = 0").select("record").unionByName(whole)
