"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Training counts hashed n-grams of every labelled training document per
language; the counts are summed by Spark (a row per language and bucket).
The smoothed log-probability matrix (buckets x languages, a few megabytes) is
broadcast, and batches of texts are scored as sparse sums of its rows in
numpy.

Cases: a null text or one without a letter gives ``und`` with score 0; with
no training rows every text is ``und``; equal scores go to the language that
sorts first; very long texts are scored whole, slice by slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tillroll.llm.common import held_out, mix64, record_batch, schema_of, slices

#: Hash buckets of n-grams (a power of two) and the n-gram lengths.
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Code points handled at once.
CHUNK = 1 << 20

_LETTER = regex.compile(r"\p{L}")
_SEEDS = {n: np.uint64(0x9E3779B97F4A7C15 * n % 2**64 | 1) for n in ORDERS}


def _code_points(text: str) -> np.ndarray:
    """Lower-cased code points with a space at both ends."""
    return np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_buckets(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of ``codes``, order by order."""
    wide = mix64(codes.astype(np.uint64) + np.uint64(1))
    for n in ORDERS:
        size = min(len(wide) - n + 1, CHUNK)
        if size <= 0:
            continue
        h = np.zeros(size, dtype=np.uint64)
        for i in range(n):
            h = h * _SEEDS[n] + wide[i : i + size]
        h ^= h >> np.uint64(32)
        yield ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(49)).astype(np.int32)


def _pieces(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Stretches of a very long text: each carries CHUNK n-gram starts and the
    code points that its last n-grams reach into."""
    if len(codes) <= CHUNK:
        yield codes
        return
    for start in range(0, len(codes), CHUNK):
        yield codes[start : start + CHUNK + max(ORDERS) - 1]


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over the training documents ``docs``; each task sums
    its documents before the shuffle."""
    schema = schema_of("lang string, bucket int, n long")
    arrow = to_arrow_schema(schema)

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, limit=1 << 20):
                grams: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    for piece in _pieces(_code_points(text)):
                        grams.setdefault(lang, []).extend(gram_buckets(piece))
                for lang, found in grams.items():
                    held = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    held += np.bincount(np.concatenate(found), minlength=BUCKETS)
        for lang, held in sums.items():
            at = np.flatnonzero(held)
            yield record_batch({"lang": [lang] * len(at), "bucket": at.astype(np.int32), "n": held[at]}, arrow)

    return (
        docs.select("lang", "text")
        .where("lang is not null and text is not null")
        .mapInArrow(run, schema)
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def fit(docs: DataFrame, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages and the (buckets x languages) matrix of log probabilities.
    What reaches the driver is bounded by languages x buckets."""
    table = count_grams(docs).toPandas()
    langs = sorted(table["lang"].unique())
    counts = np.zeros((BUCKETS, len(langs)), dtype=np.float64)
    column = {lang: i for i, lang in enumerate(langs)}
    counts[table["bucket"].to_numpy(dtype=np.int64), table["lang"].map(column).to_numpy(dtype=np.int64)] = table["n"]
    counts += smoothing
    return langs, np.log(counts / counts.sum(axis=0, keepdims=True)).astype(np.float32)


def score_texts(texts: list[str | None], langs: list[str], logs: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Best language and its posterior for each text."""
    return _scored(texts, langs, logs)[:2]


def _scored(texts: list[str | None], langs: list[str], logs: np.ndarray):
    """As ``score_texts``, with each text's mean log probability of an n-gram
    under its best language and its number of n-grams."""
    found, scores = [], np.zeros(len(texts))
    means, lengths = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text is None or not langs or not _LETTER.search(text):
            found.append("und")
            continue
        total = np.zeros(len(langs))
        grams = 0
        for piece in _pieces(_code_points(text)):
            for b in gram_buckets(piece):
                counts = np.bincount(b, minlength=BUCKETS) if len(b) > BUCKETS else None
                if counts is not None:
                    total += counts @ logs
                else:
                    total += logs[b].sum(axis=0, dtype=np.float64)
                grams += len(b)
        best = int(np.argmax(total))
        found.append(langs[best])
        scores[i] = 1.0 / np.exp(total - total[best]).sum()
        means[i], lengths[i] = total[best] / grams, grams
    return found, scores, means, lengths


def predict(
    docs: DataFrame, langs: list[str], logs: np.ndarray, keep: tuple[str, ...] = ("doc_id",), measures: bool = False
) -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score`` for every document,
    and with ``measures`` also ``mean_log`` and ``n_grams``."""
    extra = "mean_log double, n_grams long" if measures else ""
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
        + (list(schema_of(extra)) if extra else [])
    )
    arrow = to_arrow_schema(schema)
    model = docs.sparkSession.sparkContext.broadcast((langs, logs))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found, *numbers = _scored(part.column("text").to_pylist(), *model.value)
                columns = [part.column(c).cast(arrow.field(c).type) for c in keep]
                numbers = [pa.array(x) for x in (numbers if measures else numbers[:1])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), *numbers], schema=arrow)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def usual_range(train: DataFrame, langs: list[str], logs: np.ndarray) -> DataFrame:
    """(lang, middle, reach, length) of all training texts by their language:
    the median of their mean log probabilities, twice its distance to their
    lowest hundredth, and the median number of n-grams."""
    labelled = train.where("lang is not null and text is not null")
    found = predict(labelled, langs, logs, keep=("lang",), measures=True).where("n_grams > 0")
    at = F.percentile_approx("mean_log", [0.01, 0.5], 10_000)
    middle = found.groupBy("lang").agg(at.alias("at"), F.percentile_approx("n_grams", 0.5).alias("length"))
    return middle.select("lang", F.get("at", 1).alias("middle"), (2 * (F.get("at", 1) - F.get("at", 0))).alias("reach"), "length")


def fits_language(found: DataFrame, usual: DataFrame) -> DataFrame:
    """The rows of ``found`` (with measures) that read like the training texts
    of their predicted language.  A short text's mean varies more, so its
    reach grows with the root of what it lacks to the usual length."""
    usual = F.broadcast(usual.withColumnsRenamed({"lang": "lang_pred", **{c: f"usual_{c}" for c in usual.columns[1:]}}))
    wider = F.sqrt(F.greatest(F.lit(1.0), F.col("usual_length") / F.col("n_grams")))
    near = F.col("mean_log") >= F.col("usual_middle") - F.col("usual_reach") * wider
    return found.join(usual, "lang_pred").where((F.col("n_grams") > 0) & near)


def language_id(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Learn from the documents outside the held-out fold that carry a
    language; predict every document from its text alone."""
    langs, logs = fit(docs.where(~held_out()))
    return predict(docs, langs, logs, keep)
