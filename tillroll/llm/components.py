"""Connected components of an edge table, by randomized contraction.

Each round every node points to the neighbour (or itself) with the smallest
id, in every other round with the smallest hash of (round, id); edges are
rewritten to the nodes pointed to, and self-loops and repeats go.  The
expected number of nodes falls by a constant factor every two rounds whatever
the shape (stars, chains, cliques).  Hot nodes are
met by partial aggregation and ordinary joins, never by a collected list.
Every round writes its tables to the checkpoint folder; only the result stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import Scratch
from tillroll.plans.materialize import write_and_read


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b, any order,
    repeats and self-loops allowed); component is the smallest node of it."""
    pairs = edges.where("a is not null and b is not null and a <> b")
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a")).distinct()
    scratch = Scratch(edges.sparkSession)
    graph = scratch.write(both, "cc_edges")
    labels = None
    turn = 0
    while not graph.isEmpty():
        # Smallest ids fold stars in one round, smallest hashes fold chains.
        rank = (lambda c: F.col(c)) if turn % 2 == 0 else (lambda c: F.xxhash64(F.lit(turn), c))
        best = F.min(F.struct(rank("v").alias("h"), F.col("v").alias("id"))).alias("best")
        own = F.struct(rank("u").alias("h"), F.col("u").alias("id"))
        nearest = graph.groupBy("u").agg(best).select("u", F.least("best", own).getField("id").alias("to"))
        point = scratch.write(nearest, "cc_point")
        to_u, to_v = point.toDF("u", "pu"), point.toDF("v", "pv")
        graph = scratch.write(
            graph.join(to_u, "u").join(to_v, "v").select(F.col("pu").alias("u"), F.col("pv").alias("v"))
            .where("u <> v")
            .distinct(),
            "cc_edges",
        )
        if labels is None:
            labels = point.toDF("node", "root")
        else:
            moved = labels.join(point.toDF("root", "next"), "root", "left")
            labels = moved.select("node", F.coalesce("next", "root").alias("root"))
        labels = scratch.write(labels, "cc_labels")
        turn += 1
    if labels is None:
        found = both.select(F.col("u").alias("node"), F.col("v").alias("component"))  # no rows
    else:
        smallest = labels.groupBy("root").agg(F.min("node").alias("component"))
        found = labels.join(smallest, "root").select("node", "component")
    found = write_and_read(found, "components")
    scratch.drop()
    return found
