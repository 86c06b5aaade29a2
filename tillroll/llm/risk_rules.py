"""Quality rules with risk-controlled cutoffs.

A rule rejects a document when one of its statistics reaches a cutoff.  The
cutoffs are not picked by hand: for every stratum (language) and statistic
the candidate cutoffs are tried from the loosest to the strictest on the
labelled documents, and a cutoff counts as safe while the exact binomial
(Clopper-Pearson) upper bound of its rejection rate among documents labelled
good stays within the stratum's budget.

Multiple testing: a chain of cutoffs is a fixed sequence that stops at the
first unsafe one, so it spends its error level once; the level ``delta`` is
divided among all chains (strata x statistics).  The false-rejection budget
``alpha`` of a stratum is divided among its statistics, so the rules together
reject at most ``alpha`` of its good documents with confidence 1 - delta.

Cases: a null or empty text has no words and fails the base rule; a null
language is the stratum ``und``; a stratum without enough labelled good
documents gets no rule beyond the base; of repeated label rows the lowest
label counts; repeated documents each get their verdict.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.textstats import statistics, text_counts
from tillroll.plans.materialize import write_and_read

#: Statistics with a rule; larger values are worse.
RULED = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_rate")
#: Candidate cutoffs are the multiples of 1 / GRID up to 1.
GRID = 100


@dataclass(frozen=True)
class Cutoff:
    stratum: str
    statistic: str
    cutoff: float
    good: int  # labelled good documents of the stratum
    rejected: int  # of them, rejected by the cutoff
    bound: float  # exact upper bound of the rejection rate


#: Nodes and weights of the quadrature on [-1, 1].
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(256)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), in work that does not depend on n.

    It is the upper tail of the beta distribution with parameters k + 1 and
    n - k beyond p: the integral of its density from p on over the whole one.
    Both are taken by Gauss-Legendre quadrature over the places within 45
    standard deviations, of the density relative to its peak, so no large
    numbers cancel."""
    if k >= n or p <= 0.0:
        return 1.0
    if p >= 1.0 or k < 0:
        return 0.0
    if k == 0:
        return math.exp(n * math.log1p(-p))
    if k == n - 1:
        return -math.expm1(n * math.log(p))
    peak, spread = k / (n - 1), 45 * math.sqrt((k + 1) * (n - k) / (n + 2.0)) / (n + 1)
    low, high = max(0.0, peak - spread), min(1.0, peak + spread)
    if p <= low:
        return 1.0
    if p >= high:
        return 0.0

    def area(a: float, b: float) -> float:
        t = (a + b) / 2 + (b - a) / 2 * _NODES
        away = t - peak
        logs = k * np.log1p(away / peak) + (n - 1 - k) * np.log1p(-away / (1 - peak))
        return float((b - a) / 2 * (_WEIGHTS * np.exp(logs)).sum())

    # Cut at the peak, where the density is steepest on both sides.
    left, right = area(low, peak), area(peak, high)
    upper = area(p, high) if p > peak else area(p, peak) + right
    return min(1.0, upper / (left + right))


def upper_bound(k: int, n: int, level: float) -> float:
    """Clopper-Pearson upper bound at confidence 1 - ``level``: the rate p at
    which k or fewer of n has probability ``level``."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if binomial_cdf(k, n, mid) > level:
            low = mid
        else:
            high = mid
    return high


def _step(statistic: Column) -> Column:
    """The largest grid step that the statistic reaches."""
    return F.least(F.greatest(F.floor(statistic * GRID + F.lit(1e-9)), F.lit(0)), F.lit(GRID)).cast("int")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def stratum(col: str = "lang") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit("und"))


def fit_cutoffs(
    counts: DataFrame, labels: DataFrame, alpha: float = 0.03, delta: float = 0.05, ruled: tuple[str, ...] = RULED
) -> list[Cutoff]:
    """Safe cutoffs from every labelled good document that passes the base
    rule.  Only histogram rows (strata x statistics x grid steps) reach the
    driver, whatever the number of documents."""
    good = (
        labels.groupBy("doc_id").agg(F.min("quality").alias("label")).where("label = 1").select("doc_id")
    )
    stats = statistics()
    steps = F.array(*[F.struct(F.lit(n).alias("statistic"), _step(stats[n]).alias("step")) for n in ruled])
    cells = (
        counts.where(~base_failed())
        .join(good, "doc_id", "left_semi")
        .select(stratum().alias("stratum"), F.explode(steps).alias("cell"))
        .groupBy("stratum", "cell.statistic", "cell.step")
        .count()
        .collect()
    )
    strata = sorted({c["stratum"] for c in cells})
    chains = max(1, len(strata) * len(ruled))
    found = []
    for s in strata:
        for name in ruled:
            histogram = np.zeros(GRID + 1, dtype=np.int64)
            for c in cells:
                if c["stratum"] == s and c["statistic"] == name:
                    histogram[c["step"]] += c["count"]
            safe = _strictest_safe(histogram, alpha / len(ruled), delta / chains)
            if safe is not None:
                step, n, k, bound = safe
                found.append(Cutoff(s, name, step / GRID, n, k, bound))
    return found


def _strictest_safe(histogram: np.ndarray, budget: float, level: float):
    """Walk the cutoffs from loose to strict and keep the last safe one."""
    n = int(histogram.sum())
    rejected = np.cumsum(histogram[::-1])[::-1]  # at step s: documents that reach s
    kept = None
    for step in range(GRID, 0, -1):
        k = int(rejected[step])
        if n == 0 or binomial_cdf(k, n, budget) > level:  # the bound exceeds the budget
            break
        kept = (step, n, k)
    if kept is None:
        return None
    return (*kept, upper_bound(kept[2], n, level))


def rejects(cutoffs: list[Cutoff]) -> Column:
    """The rules as one column expression over the counts and ``lang``."""
    stats = statistics()
    verdict = F.lit(False)
    for c in cutoffs:
        reached = _step(stats[c.statistic]) >= round(c.cutoff * GRID)
        verdict = verdict | ((stratum() == c.stratum) & reached)
    return verdict


def quality_rules(
    docs: DataFrame, labels: DataFrame, alpha: float = 0.03, delta: float = 0.05
) -> tuple[DataFrame, list[Cutoff]]:
    """Counts and verdict (``base_failed``, ``kept``) of every document, and
    the cutoffs that gave it.  The counts are written once to the checkpoint
    folder: fitting and judging read them, not the texts."""
    counts = write_and_read(text_counts(docs, ("doc_id", "lang")), "rule_counts")
    cutoffs = fit_cutoffs(counts, labels, alpha, delta)
    judged = counts.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~rejects(cutoffs)
    )
    return judged, cutoffs
