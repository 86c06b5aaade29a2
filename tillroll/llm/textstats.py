"""Document statistics behind the quality operators.

One pass over the whole text gives every count; ratios are derived from them
with column expressions.  Words are runs of anything but ASCII white space.
A null text counts as empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import ASCII_SPACE, map_documents

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
#: Words per window of the repetition count.
WINDOW = 8

COUNTS = (
    "n_bytes",
    "n_chars_all",
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct_words",
    "n_upper",
    "n_digits",
    "n_bangs",
    "n_stops",
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by a ``window``-word sequence that occurs twice or more
    in ``words`` (every occurrence counts, overlaps once)."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    rolled = np.zeros(n, dtype=np.uint64)
    for i in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    order = np.argsort(rolled, kind="stable")
    ranked = rolled[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    starts = []
    first = None  # earliest position of the run of equal hashes
    for i in np.flatnonzero(same):
        a, b = int(order[i]), int(order[i + 1])
        if first is None or last != a:
            first = a
            starts.append(a)
        if words[first : first + window] != words[b : b + window]:
            return _repeated_words_plain(words, window)  # a hash collision
        starts.append(b)
        last = b
    return _covered(np.array(starts), len(words), window)


def _repeated_words_plain(words: list[bytes], window: int) -> int:
    seen: dict[tuple, list[int]] = {}
    for i in range(len(words) - window + 1):
        seen.setdefault(tuple(words[i : i + window]), []).append(i)
    starts = [i for places in seen.values() if len(places) > 1 for i in places]
    return _covered(np.array(starts, dtype=np.int64), len(words), window)


def _covered(starts: np.ndarray, n: int, window: int) -> int:
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + window, n), -1)
    return int((np.cumsum(step)[:n] > 0).sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one text."""
    text = text or ""
    data = text.encode("utf-8")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip(ASCII_SPACE)]
    solid = len(data.translate(None, ASCII_SPACE))
    return (
        len(data),
        len(text),
        len(words),
        solid - (len(data) - len(text)),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(set(words)),
        len(data) - len(data.translate(None, UPPER)),
        len(data) - len(data.translate(None, DIGITS)),
        data.count(b"!"),
        data.count(b"."),
    )


def _count_slice(cols: dict) -> dict:
    rows = [count_text(t) for t in cols["text"]]
    columns = list(zip(*rows)) if rows else [[]] * len(COUNTS)
    return {**cols, **dict(zip(COUNTS, columns))}


def text_counts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the counts of ``COUNTS`` for every row of
    ``docs``; other columns are not read."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def count(cols: dict) -> dict:
        got = _count_slice(cols)
        return {c: got[c] for c in schema.names}

    return map_documents(docs, count, schema, list(dict.fromkeys([*keep, "text"])))


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def statistics() -> dict[str, Column]:
    """Name and expression of every derived statistic (a double, 0 for an
    empty text)."""
    return {
        "words": F.col("n_words").cast("double"),
        "symbol_share": _share("n_symbols", "word_chars"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "upper_share": _share("n_upper", "word_chars"),
        "digit_share": _share("n_digits", "word_chars"),
        "bang_rate": _share("n_bangs", "n_words"),
        "stop_rate": _share("n_stops", "n_words"),
        "word_length": _share("word_chars", "n_words"),
        "line_words": _share("n_words", "n_lines"),
        "distinct_share": _share("n_distinct_words", "n_words"),
    }
