"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A document's sketch is the k smallest distinct 64-bit hashes of its word
shingles, in ascending order.  Sketches of parts merge into the sketch of
their union, and give estimates of resemblance, containment and the distinct
shingle count (exact while a set has at most k shingles).

Everything is a column expression (no Python on executors).

Cases: null and empty texts, and texts without a word, have an empty sketch;
two empty sketches resemble each other fully (1.0), an empty and a non-empty
one not at all; a text with fewer words than a shingle has one shingle, the
whole sequence; in ``with_next`` rows come in the order of (doc_id, text),
null ids last, and the row after the last is the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sketch size and words per shingle.
K = 128
WORDS = 5
#: Documents per bucket of neighbours, and the most buckets (their bounds are
#: a literal in the plan).
BUCKET_ROWS = 512
MOST_BUCKETS = 50_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body
    uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of anything but ASCII white space."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Array of the 64-bit hashes of a text's shingles, in order."""

    def rolled(h: Column) -> Column:
        steps = F.sequence(F.lit(0), F.size(h) - words)
        joined = F.transform(steps, lambda i: F.xxhash64(*[h[i + j] for j in range(words)]))
        few = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= words, joined).otherwise(few)

    return let(F.transform(words_of(text), lambda w: F.xxhash64(w)), rolled)


def bottom_k(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """Bottom-k sketch of a text column."""
    return bottom_k(shingle_hashes(text, words), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both
    sets hold."""
    def estimate(union: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(a, b), union))
        return F.when(F.size(union) > 0, both / F.size(union)).otherwise(F.lit(1.0))

    return let(merge(a, b, k), estimate)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles, exact below k."""
    largest = F.element_at(a, -1).cast("double") + F.lit(2.0**63)  # 0 .. 2^64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / (largest / F.lit(2.0**64)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that lies in the second."""
    def estimate(j: Column) -> Column:
        total = distinct_count(a, k) + distinct_count(b, k)
        return F.least(F.lit(1.0), j / (1 + j) * total / distinct_count(a, k))

    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(let(resemblance(a, b, k), estimate))


def fingerprint(a: Column) -> Column:
    """A sketch as text: base64 of its hashes, 8 bytes each, big-endian."""
    return F.base64(F.unhex(F.concat_ws("", F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")))))


def merge_sketches(parts: DataFrame, keys: list[str], col: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts.

    Ranks single hashes, so a key with any number of parts is never gathered:
    repeats go by partial aggregation and Spark keeps k rows per key and task
    before the shuffle."""
    hashes = parts.select(*keys, F.explode(col).alias("h")).distinct()
    least = hashes.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("h"))).where(
        F.col("place") <= k
    )
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("h")).alias(col))


def _neighbour_bounds(docs: DataFrame) -> list[int]:
    """Ascending ids that start the buckets of neighbours (ids that exist;
    the smallest comes first)."""
    size = docs.agg(F.count("doc_id").alias("n"), F.min("doc_id").alias("low")).first()
    if not size["n"]:
        return []
    n = min(MOST_BUCKETS, -(-size["n"] // BUCKET_ROWS))
    if n == 1:
        return [size["low"]]
    shares = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * max(n, 1000)).alias("at")).first()["at"]
    return sorted({size["low"], *found})


def _bucket(bounds: Column, n: int) -> Column:
    """Number of the last bound that doc_id reaches, by binary search."""
    steps = [1 << b for b in reversed(range(max(1, n.bit_length())))]
    reach = lambda i, s: F.when((i + s < n) & (F.get(bounds, i + s) <= F.col("doc_id")), i + s).otherwise(i)
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), reach)
    return F.when(F.col("doc_id").isNull(), F.lit(n - 1)).otherwise(found)


def with_next(docs: DataFrame, extra: dict[str, Column]) -> DataFrame:
    """Rows (doc_id, text, ``extra``) with ``next_*`` columns of the row that
    follows by doc_id.

    Rows are dealt once, to buckets of neighbouring ids; a bucket's first rows
    go to the bucket before as well, so every row meets its successor inside
    its own bucket."""
    bounds = _neighbour_bounds(docs)
    n = max(1, len(bounds))
    literal = F.from_json(F.lit("[" + ",".join(map(str, bounds)) + "]"), "array<bigint>")
    # (bucket, rank): 0 for the row itself, 1 where it only follows others.
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("late"))
    before = F.struct(F.pmod(F.col("bucket") - 1, F.lit(n)).alias("bucket"), F.lit(1).alias("late"))
    starts = F.get(literal, F.col("bucket")) == F.col("doc_id")
    dealt = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("bucket", _bucket(literal, n))
        .select("doc_id", "text", F.explode(F.when(starts, F.array(own, before)).otherwise(F.array(own))).alias("at"))
        .select("doc_id", "text", "at.bucket", "at.late")
        .repartition("bucket")
        .select("*", *[c.alias(name) for name, c in extra.items()])
    )
    order = Window.partitionBy("bucket").orderBy("late", F.col("doc_id").asc_nulls_last(), "text")
    carried = ["text", *extra]
    after = F.lead(F.struct(*carried)).over(order)
    return (
        dealt.withColumn("after", after)
        .where("late = 0")
        .select("doc_id", *carried, *[F.col(f"after.{c}").alias(f"next_{c}") for c in carried])
    )


def fingerprint_edits(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Sketches of every text and of its edited text (the last quarter
    replaced by the start of the next document), and their resemblances."""
    rows = with_next(docs, {"sketch": sketch(F.col("text"), k, words)})
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    text_after = F.coalesce("next_text", F.lit(""))
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(text_after, F.lit(1), quarter)
    )
    sketched = rows.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    sketched = sketched.withColumn("edited_sketch", sketch(F.col("edited"), k, words))
    next_sketch = F.coalesce("next_sketch", F.array().cast("array<bigint>"))
    return sketched.select(
        "doc_id",
        "n_chars",
        "edited",
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), next_sketch, k).alias("near_next"),
    )
