"""Quality classifier: a sparse rule ensemble.

1. Random forests of shallow trees are grown on document statistics; every
   path from a root to a node is a candidate rule (a conjunction of
   threshold conditions).
2. The rules and the linear terms get logistic weights under an L1 penalty,
   which leaves a short list of rules.
3. The surviving rules are compiled into Spark column expressions, so scoring
   is one projection over the statistics, with no model object on executors.

Both fits run as Spark jobs.  They use a bounded sample of labelled rows
(``max_rows``, the rows with the smallest hash of doc_id); scoring covers
every document.  Labels, language, source and doc_id never enter a score.

Cases: null and empty texts have all statistics 0 and get a score like any
other; repeated label rows count as their lowest label; without any labelled
row, or with one class only, every score is that class's rate (0.5 without
rows).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import held_out
from tillroll.llm.textstats import statistics, text_counts
from tillroll.plans.materialize import write_and_read

Condition = tuple[str, str, float]  # statistic, "<=" or ">", threshold
Rule = tuple[Condition, ...]

_SPLIT = re.compile(r"^\s*(If|Else) \(feature (\d+) (<=|>) ([-+\d.eE]+)\)")


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]
    linear: tuple[tuple[str, float], ...]

    def score(self) -> Column:
        """Probability of label 1 as a column expression over the counts."""
        stats = statistics()
        total = F.lit(self.intercept)
        for name, weight in self.linear:
            total = total + F.lit(weight) * _linear_term(stats[name])
        for rule, weight in self.weights:
            total = total + F.when(_holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return (F.lit(1.0) / (F.lit(1.0) + F.exp(-total))).cast("double")


def _linear_term(value: Column) -> Column:
    """Statistics enter linearly as log(1 + x), which tames long texts."""
    return F.log1p(value)


def _holds(rule: Rule, stats: dict[str, Column]) -> Column:
    out = F.lit(True)
    for name, op, threshold in rule:
        value = stats[name]
        out = out & (value <= F.lit(threshold) if op == "<=" else value > F.lit(threshold))
    return out


def tree_rules(debug_string: str, names: list[str]) -> set[Rule]:
    """Every path to an inner or leaf node of the trees that Spark prints,
    with conditions on one statistic merged to its tightest bounds."""
    rules: set[Rule] = set()
    path: list[Condition] = []
    base = 0
    for row in debug_string.splitlines():
        if row.lstrip().startswith("Tree "):
            path = []
            base = len(row) - len(row.lstrip())
            continue
        m = _SPLIT.match(row)
        if not m:
            continue
        depth = len(row) - len(row.lstrip()) - base - 2
        path = path[:depth] + [(names[int(m[2])], m[3], float(m[4]))]
        rules.add(_tight(path))
    return rules


def _tight(path: list[Condition]) -> Rule:
    best: dict[tuple[str, str], float] = {}
    for name, op, t in path:
        key = (name, op)
        best[key] = t if key not in best else (min if op == "<=" else max)(best[key], t)
    return tuple(sorted((n, op, t) for (n, op), t in best.items()))


def fit_rules(
    labelled: DataFrame,
    n_trees: int = 16,
    depth: int = 3,
    l1: float = 0.002,
    seed: int = 7,
) -> RuleModel:
    """Fit on ``labelled``: the counts of ``textstats`` and a 0/1 ``label``.
    All distinct paths (at most n_trees * (2 ** (depth + 1) - 2)) are
    candidates; the penalty chooses among them."""
    names = list(statistics())
    classes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    total = sum(classes.values())
    if len(classes) < 2:
        rate = (classes.get(1, 0) + 0.5) / (total + 1)
        return RuleModel(math.log(rate / (1 - rate)), (), ())
    stats = labelled.select(
        F.col("label").cast("double").alias("label"), *[c.alias(n) for n, c in statistics().items()]
    )
    table = VectorAssembler(inputCols=names, outputCol="stats").transform(stats)
    forest = RandomForestClassifier(
        featuresCol="stats", labelCol="label", numTrees=n_trees, maxDepth=depth, maxBins=64, seed=seed,
        subsamplingRate=0.7, featureSubsetStrategy="onethird",
    ).fit(table)
    found = sorted(tree_rules(forest.toDebugString, names), key=lambda r: (len(r), r))
    # An inner split gives two complementary one-condition rules; one is enough.
    rules = [r for r in found if not (len(r) == 1 and r[0][1] == "<=")]
    columns = statistics()
    terms = [_linear_term(columns[n]).alias(f"lin_{i}") for i, n in enumerate(names)]
    tests = [_holds(r, columns).cast("double").alias(f"rule_{i}") for i, r in enumerate(rules)]
    inputs = [f"lin_{i}" for i in range(len(names))] + [f"rule_{i}" for i in range(len(rules))]
    design = VectorAssembler(inputCols=inputs, outputCol="x").transform(
        labelled.select(F.col("label").cast("double").alias("label"), *terms, *tests)
    )
    fit = LogisticRegression(
        featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=l1, maxIter=80, standardization=True
    ).fit(design.select("x", "label"))
    w = fit.coefficients.toArray()
    return RuleModel(
        float(fit.intercept),
        tuple((r, float(v)) for r, v in zip(rules, w[len(names) :]) if v != 0.0),
        tuple((n, float(v)) for n, v in zip(names, w[: len(names)]) if v != 0.0),
    )


def training_rows(counts: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """At most about ``max_rows`` labelled documents outside the held-out
    fold, chosen by the hash of their id (all of them while there are fewer).

    The threshold on the hash comes from the number of labels, so no sort and
    no single task is involved."""
    known = (
        labels.where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("label")).where("label in (0, 1)")
    )
    n = known.count()
    if n > max_rows:
        share = max_rows * 2**63 // n  # of the hashes' upper 63 bits
        known = known.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 1) < share)
    return counts.join(known, "doc_id")


def fit_quality(counts: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> RuleModel:
    """Fit on the labelled training rows of a written table of counts."""
    return fit_rules(write_and_read(training_rows(counts, labels, max_rows), "quality_sample"))


def judge(counts: DataFrame, model: RuleModel, cutoff: float = 0.7) -> DataFrame:
    """Adds ``held_out``, ``score`` and ``predicted``."""
    scored = counts.withColumn("held_out", held_out()).withColumn("score", model.score())
    return scored.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def quality_classifier(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> tuple[DataFrame, RuleModel]:
    """``held_out``, ``score`` and ``predicted`` of every document, and the
    model.  The counts are written once to the checkpoint folder; fitting and
    scoring read them."""
    counts = write_and_read(text_counts(docs), "quality_counts")
    model = fit_quality(counts, labels, max_rows)
    return judge(counts, model), model


def keep_predicted(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier predicts as 1.
    Only counts are written in between; the texts pass once more to be judged
    and kept in one step, without a join."""
    _, model = quality_classifier(docs, labels, max_rows)
    return judge(text_counts(docs, tuple(docs.columns)), model).where("predicted = 1").select(*docs.columns)
