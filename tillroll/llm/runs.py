"""Runs (maximal periodic stretches) in word sequences.

A run is a stretch of consecutive words with smallest period q whose length
is at least ``max(least, exponent * q)`` and that no neighbouring word extends
keeping the period.  They are found on harmonic grids: for each period p only
the grid places 0, p, 2p, ... are asked how far the words there and p words on
agree to the right and to the left, which is n/1 + n/2 + ... questions.

The questions are longest-common-extension queries (LCE) answered by a
difference cover: of the residues modulo V a small set D holds a pair for
every difference, so within V words after any two places there is a pair of
places that both lie in the cover.  Only suffixes at cover places are sorted
(by doubling, V words at first); a query compares up to V words one by one
and, if they are all equal, reads the rest from the common prefixes of
neighbouring sorted suffixes by a sparse-table range minimum.

A stretch of at least ``exponent`` periods holds as many grid places in a
row, all with equal words, so grid places without that are never queried, and
only documents with such places enter the sorted structure.  The documents of
a slice are one sequence, longest first, with a mark of its own after each,
so no extension leaves its document.

Cases: null and empty texts have no words and no runs; ``collapsed`` is then
the empty text; rows that repeat are handled one by one; a text of one word
repeated is one run; texts of any length are handled whole, queries in
batches of ``BATCH``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import map_documents, schema_of

#: Modulus and residues of the difference cover (each of the
#: differences 1 to 12 is one of two residues modulo 13, once).
V = 13
COVER = (0, 1, 3, 9)
#: LCE queries answered at once.
BATCH = 1 << 20


def _cover_shift() -> np.ndarray:
    """shift[a, b]: least d with a + d and b + d both in the cover (mod V)."""
    inside = np.isin(np.arange(V), COVER)
    d = np.arange(V)
    both = inside[(np.arange(V)[:, None, None] + d) % V] & inside[(np.arange(V)[None, :, None] + d) % V]
    return both.argmax(axis=2)


_SHIFT = _cover_shift()


class CommonExtensions:
    """LCE queries over a sequence of non-negative integers.  The sequence
    must end in at least V marks that occur nowhere else and differ from each
    other, so no two different places agree up to the end."""

    def __init__(self, seq: np.ndarray):
        self.seq = seq
        n = len(seq)
        places = np.flatnonzero(np.isin(np.arange(n) % V, COVER))
        places = places[places <= n - V]
        self.number = np.full(n + V + 1, -1, dtype=np.int64)  # sample number of a place
        self.number[places] = np.arange(len(places))
        m = len(places)
        # Ranks of the first V words, a few words at a time.
        base = int(seq.max(initial=0)) + 1
        per = max(1, int(62 // max(1, base.bit_length())) - 1)
        rank = np.zeros(m, dtype=np.int64)
        at = 0
        while at < V:
            key = rank
            for k in range(at, min(V, at + per)):
                key = key * base + seq[places + k]
            rank = np.unique(key, return_inverse=True)[1] if m else key
            at += per
            per = max(1, int((62 - m.bit_length()) // max(1, base.bit_length())))
        # Doubling: places V * 2^k on are in the cover too.
        follow = self.number[places + V]
        levels = [rank]
        while m and rank.max() + 1 < m:
            second = np.where(follow >= 0, rank[follow], -1) + 1
            rank = np.unique(rank * (m + 1) + second, return_inverse=True)[1]
            levels.append(rank)
            follow = np.where(follow >= 0, follow[follow], -1)
        self.rank = rank
        order = np.argsort(rank, kind="stable")
        self.table = [self._neighbours(order, places, levels)]
        step = 1
        while 2 * step <= len(self.table[0]):
            last = self.table[-1]
            self.table.append(np.minimum(last[: len(last) - step], last[step:]))
            step *= 2

    def _neighbours(self, order, places, levels) -> np.ndarray:
        """Common prefix of each sorted suffix and the next one: whole levels
        from the highest down, then word by word."""
        a, b = order[:-1], order[1:]
        if len(a) == 0:
            return np.zeros(0, dtype=np.int64)
        x, y = places[a].copy(), places[b].copy()
        total = np.zeros(len(a), dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            nx, ny = self.number[x], self.number[y]
            same = (nx >= 0) & (ny >= 0)
            same[same] = levels[k][nx[same]] == levels[k][ny[same]]
            step = same * (V << k)
            x += step
            y += step
            total += step
        return total + self._direct(x, y, V)

    def _direct(self, x: np.ndarray, y: np.ndarray, most) -> np.ndarray:
        """Equal words from x and y on, at most ``most`` (below V + 1)."""
        out = np.zeros(len(x), dtype=np.int64)
        open_ = np.arange(len(x))
        most = np.broadcast_to(most, len(x))
        for k in range(V):
            open_ = open_[most[open_] > k]
            i, j = x[open_] + k, y[open_] + k
            inside = (i < len(self.seq)) & (j < len(self.seq))
            open_, i, j = open_[inside], i[inside], j[inside]
            open_ = open_[self.seq[i] == self.seq[j]]
            if len(open_) == 0:
                break
            out[open_] = k + 1
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j
        (different places)."""
        shift = _SHIFT[i % V, j % V]
        out = self._direct(i, j, shift)
        on = np.flatnonzero(out == shift)
        x, y = i[on] + shift[on], j[on] + shift[on]
        sx, sy = self.number[x], self.number[y]
        known = (sx >= 0) & (sy >= 0)
        extra = np.zeros(len(on), dtype=np.int64)
        lo = np.minimum(self.rank[sx[known]], self.rank[sy[known]])
        hi = np.maximum(self.rank[sx[known]], self.rank[sy[known]])
        extra[known] = self._minimum(lo, hi)
        # Near the marks at the end there is no sample: word by word.
        extra[~known] = self._direct(x[~known], y[~known], V)
        out[on] += extra
        return out

    def _minimum(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least of the neighbours' common prefixes lo .. hi - 1."""
        if len(lo) == 0:
            return np.zeros(0, dtype=np.int64)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1  # floor(log2(width))
        out = np.empty(len(lo), dtype=np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.table[k]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << int(k))])
        return out


def _grid(seq: np.ndarray, p: int, limit: int, exponent: int) -> np.ndarray:
    """Grid places of period ``p`` below ``limit`` from which ``exponent``
    grid places in a row hold the same word."""
    g = seq[: limit : p]
    same = g[1:] == g[:-1]
    need = exponent - 1
    if len(same) < need:
        return np.empty(0, dtype=np.int64)
    run = same[: len(same) - need + 1].copy()
    for k in range(1, need):
        run &= same[k : len(same) - need + 1 + k]
    return np.flatnonzero(run) * p


def find_runs(docs: list[np.ndarray], least: int = 6, exponent: int = 4) -> list[np.ndarray]:
    """Runs of each document (an array of word numbers): rows of (start,
    length, period) by start, then period."""
    out = [np.empty((0, 3), dtype=np.int64) for _ in docs]
    order = sorted((i for i, d in enumerate(docs) if len(d) >= max(least, exponent)), key=lambda i: -len(docs[i]))
    if not order:
        return out
    sizes = np.array([len(docs[i]) for i in order], dtype=np.int64)
    # A mark of its own after each document.
    top = 1 + max(int(docs[i].max()) for i in order)
    origin = np.cumsum(np.r_[0, sizes + 1])
    seq = np.empty(int(origin[-1]), dtype=np.int64)
    for k, i in enumerate(order):
        seq[origin[k] : origin[k + 1] - 1] = docs[i]
        seq[origin[k + 1] - 1] = top + k
    # Candidates: only documents of at least exponent * p words can hold p.
    touched = np.zeros(len(order), dtype=bool)
    grids = []
    for p in range(1, int(sizes[0]) // exponent + 1):
        limit = int(origin[np.searchsorted(-sizes, -exponent * p, side="right")])
        at = _grid(seq, p, limit, exponent)
        if len(at):
            grids.append((p, at))
            touched[np.searchsorted(origin, at, side="right") - 1] = True
    if not grids:
        return out
    # The sorted structures hold the touched documents alone.
    held = np.flatnonzero(touched)
    words, names = np.unique(np.concatenate([seq[origin[k] : origin[k + 1]] for k in held]), return_inverse=True)
    tail = len(words) + np.arange(V)
    body = len(names)
    ahead = CommonExtensions(np.r_[names, tail])
    back = CommonExtensions(np.r_[names[::-1], tail])
    begin = np.zeros(len(order), dtype=np.int64)
    begin[held] = np.r_[0, np.cumsum(sizes[held] + 1)[:-1]]
    found = np.empty((0, 3), dtype=np.int64)
    batch: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def settle() -> np.ndarray:
        i = np.concatenate([b[0] for b in batch])
        p = np.concatenate([b[1] for b in batch])
        right = ahead.lce(i, i + p)
        left = np.zeros(len(i), dtype=np.int64)
        some = np.flatnonzero(i > 0)
        # The word before i stands at body - i in the reversed sequence.
        left[some] = back.lce(body - i[some], body - i[some] - p[some])
        rows = np.stack([i - left, left + right + p, p], axis=1)
        rows = np.concatenate([found, rows[rows[:, 1] >= np.maximum(least, exponent * p)]])
        # The same stretch is found for multiples of its period too.
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)][: len(rows)]
        return rows[new]

    for p, at in grids:
        number = np.searchsorted(origin, at, side="right") - 1
        at = at - origin[number] + begin[number]
        for a in range(0, len(at), BATCH):
            part = at[a : a + BATCH]
            batch.append((part, np.full(len(part), p, dtype=np.int64)))
            waiting += len(part)
            if waiting >= BATCH:
                found = settle()
                batch, waiting = [], 0
    if batch:
        found = settle()
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    bounds = np.searchsorted(found[:, 0], np.r_[begin[held], body])
    for k, a, b in zip(held.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
        if b > a:
            rows = found[a:b].copy()
            rows[:, 0] -= begin[k]
            out[order[k]] = rows
    return out


def _dropped(n: int, rows: np.ndarray) -> np.ndarray:
    """True for words inside a run after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def periodic_runs(
    docs: DataFrame, least: int = 6, exponent: int = 4, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns and per document ``n_words``, ``runs`` (start, length,
    period in words, by start and then period), ``best`` (the run with the
    greatest length / period; ties: least start, then period; null without a
    run) and ``collapsed`` (the words joined by one space, each run cut to its
    first period)."""
    run_type = schema_of("start long, length long, period long")
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(run_type)),
            T.StructField("best", run_type),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def named(row) -> dict:
        return dict(zip(("start", "length", "period"), map(int, row)))

    def run(cols: dict) -> dict:
        split = [(t or "").encode("utf-8").split() for t in cols["text"]]
        numbers: dict[bytes, int] = {}
        for words in split:
            for w in words:
                numbers.setdefault(w, len(numbers))
        found = find_runs(
            [np.fromiter(map(numbers.__getitem__, w), dtype=np.int64, count=len(w)) for w in split], least, exponent
        )
        best, collapsed = [], []
        for words, rows in zip(split, found):
            if len(rows):
                # length / period is exact enough in double: two different
                # fractions of numbers below 2^26 differ by more than 2^-52.
                k = np.lexsort((rows[:, 2], rows[:, 0], -(rows[:, 1] / rows[:, 2])))[0]
                best.append(named(rows[k]))
                lost = _dropped(len(words), rows)
                words = [w for w, x in zip(words, lost.tolist()) if not x]
            else:
                best.append(None)
            collapsed.append(b" ".join(words).decode("utf-8"))
        return {
            **{c: cols[c] for c in keep},
            "n_words": [len(w) for w in split],
            "runs": [[named(r) for r in rows] for rows in found],
            "best": best,
            "collapsed": collapsed,
        }

    return map_documents(docs, run, schema, list(dict.fromkeys([*keep, "text"])))


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with periodic texts planted into a tenth of the documents, by
    the CRC-32 of the doc_id: with h % 10 = 0, g = h div 10 and n words, each
    word i from a = g % n on becomes word a + (i - a) % p with
    p = 1 + (n - a) div (3 + g % 8); the words of such a text are joined by
    one space.  Column expressions only; a null doc_id or text stays."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def planted(words):
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        block = F.slice(words, (a + 1).cast("int"), p.cast("int"))
        times = F.ceil((n - a) / p).cast("int")
        whole = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.flatten(F.array_repeat(block, times)))
        return F.when(n > 0, F.concat_ws(" ", F.slice(whole, F.lit(1), n.cast("int"))))

    # The words are bound once, as the element of a one-element array.
    words = F.array(F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1)))
    changed = F.element_at(F.transform(words, planted), 1)
    return docs.withColumn("text", F.when(h % 10 == 0, F.coalesce(changed, F.col("text"))).otherwise(F.col("text")))
