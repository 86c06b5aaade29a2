"""Deterministic per-group ranking.

``top_n`` keeps the first ``n`` rows of each group.  Groups are cut in two
levels: first per (group, slice of its rows), which runs in parallel however
large a group is, then per group over at most slices x n rows.  For small
``n`` Catalyst adds a partial ``WindowGroupLimit`` before each shuffle.

``rank_all`` numbers every row of every group: range-partition on (group,
order), number rows inside each slice, and add the row counts of the earlier
slices of the same group.  A group may span any number of slices.

``rank_by_value`` does the same for the order (value descending, key
ascending) of few groups, in one lazy plan: the slices come from a mergeable
histogram of the value, so no job runs while the plan is built.  With a limit
only slices that begin below it are ranked, which gives the first ``n`` of a
group for any ``n`` without a task that holds them all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.plans.materialize import reliable_checkpoint

def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


#: Slices of a group at the first level of ``top_n``.
SLICES = 16


def top_n(df: DataFrame, group_cols, order_cols, n: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n within each group; ``rank_col`` is BIGINT."""
    groups, order = _cols(group_cols), _cols(order_cols)
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(SLICES)))
    w = Window.partitionBy(*groups, "_slice").orderBy(*order)
    first = sliced.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n).drop("_slice", rank_col)
    w = Window.partitionBy(*groups).orderBy(*order)
    return (
        first.withColumn(rank_col, F.row_number().over(w))
        .filter(F.col(rank_col) <= n)
        .withColumn(rank_col, F.col(rank_col).cast("bigint"))
    )


def rank_all(
    df: DataFrame, group_cols, order_cols, rank_col: str = "rank", num_partitions: int | None = None
) -> DataFrame:
    """Number every row 1..k within its group in ``order_cols`` order.

    ``order_cols`` must make the order total inside a group (end with a key).
    ``group_cols`` are names.  The sorted slices are written once to the
    checkpoint folder, because they are read twice (counted, then numbered).
    """
    spark = df.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _cols(group_cols) + _cols(order_cols)
    # Slices hold consecutive runs of the global (group, order) sequence, and
    # the row id grows along it: (slice index << 33) + position in slice.
    tagged = (
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_rid", F.monotonically_increasing_id())
    )
    # Fix slice membership and ids before they are used twice.
    tagged = reliable_checkpoint(tagged).withColumn("_pid", F.shiftright("_rid", 33))
    gnames = [c for c in group_cols]
    # At most (slices x groups) rows.
    counts = tagged.groupBy("_pid", *gnames).agg(F.min("_rid").alias("_r0"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*gnames).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_pid").alias("_opid"),
        *[F.col(g).alias(f"_o_{g}") for g in gnames],
        "_r0",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"),
    )
    cond = reduce(
        lambda a, b: a & b,
        [tagged["_pid"] == offsets["_opid"]] + [tagged[g].eqNullSafe(offsets[f"_o_{g}"]) for g in gnames],
    )
    ranked = tagged.join(offsets, cond).withColumn(
        rank_col, (F.col("_off") + F.col("_rid") - F.col("_r0") + 1).cast("bigint")
    )
    return ranked.drop("_rid", "_pid", "_opid", "_r0", "_off", *[f"_o_{g}" for g in gnames])


#: Slices of a group in ``rank_by_value`` (quantiles of its values).
VALUE_SLICES = 256
#: Bytes of a text key that its slices look at, after the common prefix.
KEY_BYTES = 7
#: Rows per group up to which ``top_by_value`` ranks in one task.
TASK_ROWS = 4096


def _quantiles(col: Column) -> Column:
    """Ascending distinct quantiles (values that occur)."""
    shares = F.array(*[F.lit(i / VALUE_SLICES) for i in range(VALUE_SLICES + 1)])
    return F.array_sort(F.array_distinct(F.percentile_approx(col, shares, F.lit(20 * VALUE_SLICES))))


def _place(bounds: Column, v: Column) -> Column:
    """Twice the number of bounds below ``v``, plus one if ``v`` is a bound:
    rises with ``v``, and a frequent value has a place of its own."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range((VALUE_SLICES + 1).bit_length()))])
    n = F.size(bounds)
    below = F.aggregate(
        steps, F.lit(0), lambda i, s: F.when((i + s <= n) & (F.get(bounds, i + s - 1) < v), i + s).otherwise(i)
    )
    return 2 * below + F.coalesce(F.get(bounds, below) == v, F.lit(False)).cast("int")


def _common_prefix(low: Column, high: Column) -> Column:
    """Characters that two texts have in common at their beginning."""
    size = F.least(F.length(low), F.length(high))
    same = lambda k: F.substring(low, F.lit(1), k) == F.substring(high, F.lit(1), k)
    # Binary search on the length (at most 2^16 characters are looked at).
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(17))])
    return F.aggregate(steps, F.lit(0), lambda i, s: F.when((i + s <= size) & same(i + s), i + s).otherwise(i))


def _key_number(key: Column, skip: Column) -> Column:
    """A whole number that rises with a text: the bytes after ``skip``
    characters."""
    rest = F.substring(key, skip + 1, F.lit(KEY_BYTES))
    digits = F.rpad(F.substring(F.hex(F.encode(rest, "UTF-8")), 1, 2 * KEY_BYTES), 2 * KEY_BYTES, "0")
    return F.conv(digits, 16, 10).cast("bigint")


def rank_by_value(
    df: DataFrame, group_cols, value: str, key: str, rank_col: str = "rank", limit: int | None = None
) -> DataFrame:
    """Number the rows of each group 1..k by ``value`` descending, then
    ``key`` (distinct in the group) ascending; with ``limit`` the first ones.

    Groups must be few (months): the bounds of their slices (some 2 KB a
    group) and the rows in each slice are broadcast.  A value that many rows
    share is a slice of its own, cut again by the key, so a task holds about
    1 / ``VALUE_SLICES`` of a group.  ``df`` is read three times; where it is
    an aggregate, Spark reuses its exchange.  Null values and groups are not
    allowed."""
    groups = list(group_cols)
    text_key = dict(df.dtypes)[key] == "string"
    bounds = df.groupBy(*groups).agg(_quantiles(-F.col(value).cast("double")).alias("_bounds"))
    sliced = df.join(F.broadcast(bounds), groups).withColumn("_slice", _place(F.col("_bounds"), -F.col(value).cast("double")))
    sliced = sliced.drop("_bounds")
    # Frequent values: an odd slice with more than its share of the group (its
    # exact values may still differ where doubles do not).
    held = sliced.groupBy(*groups, "_slice").agg(
        F.count(F.lit(1)).alias("_n"), F.min(key).alias("_low"), F.max(key).alias("_high"),
        (F.min(value) == F.max(value)).alias("_one"),
    )
    share = F.sum("_n").over(Window.partitionBy(*groups)) / VALUE_SLICES
    often = held.withColumn("_share", share).where((F.col("_slice") % 2 == 1) & F.col("_one") & (F.col("_n") > 2 * F.col("_share")))
    skip = _common_prefix(F.col("_low"), F.col("_high")) if text_key else F.lit(0)
    often = often.select(*groups, "_slice", skip.alias("_skip"))
    number = _key_number(F.col(key), F.col("_skip")) if text_key else F.col(key)
    crowd = sliced.join(F.broadcast(often), [*groups, "_slice"])
    cuts = crowd.groupBy(*groups, "_slice", "_skip").agg(_quantiles(number).alias("_cuts"))
    cut = sliced.join(F.broadcast(cuts), [*groups, "_slice"], "left")
    part = F.when(F.col("_cuts").isNotNull(), _place(F.col("_cuts"), number)).otherwise(F.lit(0))
    cut = cut.withColumn("_part", part).drop("_cuts", "_skip")
    # At most two rows a slice and group, and as many for each frequent value.
    sizes = cut.groupBy(*groups, "_slice", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_slice", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*groups, "_slice", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    placed = cut.join(F.broadcast(offsets), [*groups, "_slice", "_part"])
    if limit is not None:
        placed = placed.where(F.col("_off") < limit)
    own = Window.partitionBy(*groups, "_slice", "_part").orderBy(F.desc(value), F.asc(key))
    ranked = placed.withColumn(rank_col, (F.col("_off") + F.row_number().over(own)).cast("bigint"))
    if limit is not None:
        ranked = ranked.where(F.col(rank_col) <= limit)
    return ranked.select(*df.columns, rank_col)


def top_by_value(df: DataFrame, group_cols, value: str, key: str, n: int, rank_col: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group by ``value`` descending, then
    ``key``: in one task a group while they fit it, else by slices."""
    if n <= TASK_ROWS:
        return top_n(df, group_cols, [F.desc(value), F.asc(key)], n, rank_col)
    return rank_by_value(df, group_cols, value, key, rank_col, limit=n)
