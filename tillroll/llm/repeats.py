"""Removal of repeated passages with merged Burrows-Wheeler transforms.

A byte goes when a ``length``-byte string that covers it also starts in a
document with a smaller doc_id.  The texts are taken as UTF-8 bytes.

1. Anchors.  Every ``length``-byte window is represented by its smallest
   hashed ``ANCHOR``-byte substring (leftmost on ties).  Equal windows have
   equal anchors, so a window whose anchor occurs in one document only is
   unique.  The first pass counts the documents of every anchor, with sums
   per task before the shuffle.
2. Passages.  Windows with a shared anchor, run by run, are the passages.
   Each block of documents sends every distinct passage once, under its
   smallest document; later documents of the block lose a repeated passage
   there and then.  Anchors met in a large share of all documents (a bounded
   list) are avoided where a window has another anchor, so that the texts
   around a very common passage spread over many buckets.
3. Shard transforms.  A bucket of anchors receives passages from many blocks.
   They are cut into shards; each shard's suffixes are sorted to ``length``
   symbols, which gives its Burrows-Wheeler transform (read in steps of
   ``STEP`` symbols).
4. Merge.  The transforms are merged by refining their interleave: each round
   deals the interleaved transform stably by symbol, after which the merged
   suffixes are ordered by ``STEP`` more symbols; no suffix is compared or
   sorted again.  Interval borders are carried along: a border appears where
   the symbol or the interval of the round before changes, so after the last
   round the intervals are the strings of ``length`` symbols with their
   occurrences (common prefixes of at least ``length``).  An interval's
   smallest document keeps the string, all others lose it.
5. The lost spans go back to the documents' blocks and are cut out.

Only tables of anchors and spans are written in between; texts are shuffled
by block.  Nothing is collected but the bounded list of hot anchors.

Cases: null and empty texts have 0 bytes and nothing removed; texts shorter
than ``length`` are left whole; a document never removes its own repeats;
rows with equal doc_id are not earlier than each other; rows with a null
doc_id neither lose nor cause removal.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tillroll.llm.common import mix64, record_batch, schema_of, slices
from tillroll.plans.materialize import write_and_read

#: Bytes of an anchor (a window must be longer), symbols per merge round.
ANCHOR = 25
STEP = 5
#: Text per block of documents and per bucket of anchors.
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 2 << 20
#: Symbols per shard of a bucket, and of what is merged at once.
SHARD = 1 << 16
MERGE = 1 << 20
#: An anchor is hot in more documents than this share (and HOT_LEAST).
HOT_SHARE = 1 / 200
HOT_LEAST = 1000

_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 28) - 1)
_LOW = np.uint64((1 << 32) - 1)
_TOP = np.uint64(2**64 - 1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 2**64))


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``ANCHOR`` bytes from every place (by doubling)."""
    n = len(data) - ANCHOR + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    width, h = 1, data.astype(np.uint64) + np.uint64(1)
    parts = {1: h}
    while 2 * width <= ANCHOR:
        h = h[:-width] * _power(width) + h[width:]
        width *= 2
        parts[width] = h
    out, done = None, 0
    for w in sorted(parts, reverse=True):
        if done + w <= ANCHOR:
            piece = parts[w][done : done + n]
            out = piece if out is None else out * _power(w) + piece
            done += w
    return mix64(out[:n].copy())


def window_anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest hash in each run of ``width`` places."""
    if len(hashes) < width:
        return np.empty(0, dtype=np.int64)
    low = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    return (_slide(low, width) & _PLACE).astype(np.int64)


def _slide(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every ``width`` consecutive values."""
    size, span = values, 1
    while 2 * span <= width:
        size = np.minimum(size[:-span], size[span:])
        span *= 2
    rest = width - span
    return np.minimum(size[: len(size) - rest], size[rest:]) if rest else size


def _codes(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (high half) and the low 32 hash bits of each anchor."""
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (hashes & _LOW)


def _bytes_of(text) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8") if text else b"", dtype=np.uint8)


# --- pass 1: which anchors occur in several documents --------------------

_SINGLE, _MANY, _KNOWN = 0, 1, 2


def _block_type(blocks: int) -> type:
    return np.uint16 if blocks <= 1 << 16 else np.uint32


def _anchor_rows(docs: DataFrame, length: int, buckets: int, blocks_type: type) -> DataFrame:
    """(target, kind, codes, extra) per task: anchors of one document of the
    task with its block; anchors of several with their count; and the blocks
    of the latter, which are shared whatever other tasks hold."""
    schema = schema_of("target int, kind int, codes binary, extra binary")
    arrow = to_arrow_schema(schema)

    def rows(kind: int, codes: np.ndarray, extra: np.ndarray, turn: int) -> pa.RecordBatch:
        target = (codes >> np.uint64(32)).astype(np.int64)
        order = np.argsort(target, kind="stable")
        codes, extra, target = codes[order], extra[order], target[order]
        cuts = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.empty(0, np.int64)
        ends = np.r_[cuts[1:], len(target)]
        shift = turn if kind == _KNOWN else 0
        low = codes if kind == _KNOWN else (codes & _LOW).astype(np.uint32)
        return record_batch(
            {
                "target": ((target[cuts] + shift) % buckets).astype(np.int32),
                "kind": np.full(len(cuts), kind, dtype=np.int32),
                "codes": [low[a:b].tobytes() for a, b in zip(cuts, ends)],
                "extra": [extra[a:b].tobytes() for a, b in zip(cuts, ends)],
            },
            arrow,
        )

    def flush(codes: list, blocks: list, turn: int):
        code = np.concatenate(codes)
        block = np.concatenate(blocks)
        order = np.argsort(code, kind="stable")
        code, block = code[order], block[order]
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        count = np.diff(np.r_[first, len(code)])
        one = first[count == 1]
        yield rows(_SINGLE, code[one], block[one], turn)
        many = count > 1
        yield rows(_MANY, code[first[many]], count[many].astype(np.uint32), turn)
        known = np.repeat(many, count)
        yield rows(_KNOWN, code[known], block[known], turn)

    def run(batches):
        codes, blocks, held, turn = [], [], 0, 0
        for batch in batches:
            for part in slices(batch):
                for block, text in zip(part.column("block").to_pylist(), part.column("text").to_pylist()):
                    h = anchor_hashes(_bytes_of(text))
                    at = window_anchors(h, length - ANCHOR + 1)
                    if not len(at):
                        continue
                    at = at[np.r_[True, at[1:] != at[:-1]]]
                    found = np.unique(_codes(h[at], buckets))
                    codes.append(found)
                    blocks.append(np.full(len(found), block, dtype=blocks_type))
                    held += len(found)
                    turn = (turn * 31 + block) % 2**20
                    if held > 2_000_000:
                        yield from flush(codes, blocks, turn)
                        codes, blocks, held = [], [], 0
        if held:
            yield from flush(codes, blocks, turn)

    return docs.select("block", "text").mapInArrow(run, schema)


def _shared_anchors(rows: DataFrame, hot_count: int, blocks_type: type) -> DataFrame:
    """(block, codes): the anchors of a block that several documents have;
    block -1 lists the hot ones."""

    def share(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bucket = np.uint64(key[0]) << np.uint64(32)
        pick = lambda kind, col, t: np.concatenate(
            [np.empty(0, t), *[np.frombuffer(x, t) for x in frame.loc[frame["kind"] == kind, col]]]
        )
        one, block = pick(_SINGLE, "codes", np.uint32), pick(_SINGLE, "extra", blocks_type)
        many, count = pick(_MANY, "codes", np.uint32), pick(_MANY, "extra", np.uint32)
        low, place = np.unique(np.r_[one, many], return_inverse=True)
        total = np.bincount(place, weights=np.r_[np.ones(len(one)), count], minlength=len(low))
        hit = total[place[: len(one)]] > 1
        codes = np.r_[one[hit].astype(np.uint64) | bucket, pick(_KNOWN, "codes", np.uint64)]
        blocks = np.r_[block[hit], pick(_KNOWN, "extra", blocks_type)].astype(np.int64)
        hot = low[total >= hot_count].astype(np.uint64) | bucket
        codes, blocks = np.r_[codes, hot], np.r_[blocks, np.full(len(hot), -1)]
        return _by_block(blocks, codes)

    return rows.groupBy("target").applyInPandas(share, "block long, codes binary")


def _by_block(blocks: np.ndarray, codes: np.ndarray) -> pd.DataFrame:
    order = np.lexsort((codes, blocks))
    blocks, codes = blocks[order], codes[order]
    cuts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else np.empty(0, np.int64)
    ends = np.r_[cuts[1:], len(blocks)]
    return pd.DataFrame(
        {"block": blocks[cuts], "codes": [np.unique(codes[a:b]).tobytes() for a, b in zip(cuts, ends)]}
    )


# --- pass 2: passages of a block ------------------------------------------


def _member(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    if not len(ranked):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)
    return ranked[at] == values


def passages(
    data: np.ndarray, shared: np.ndarray, hot: np.ndarray, length: int, buckets: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, anchor code) of each run of windows with one shared
    anchor; ``end`` is the end of the run's last window."""
    h = anchor_hashes(data)
    at = window_anchors(h, length - ANCHOR + 1)
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    code = _codes(h, buckets)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    runs = np.diff(np.r_[first, len(at)])
    wanted = np.repeat(_member(code[at[first]], shared), runs)
    if len(hot) and _member(code[at[first]], hot).any():
        common = _member(code, hot)
        low = np.where(common, _TOP, (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64))
        other = _slide(low, length - ANCHOR + 1)
        moved = common[at] & (other != _TOP)
        at = np.where(moved, (other & _PLACE).astype(np.int64), at)
        wanted |= moved
    starts = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (wanted[1:] != wanted[:-1])])
    ends = np.r_[starts[1:], len(at)] - 1 + length
    keep = wanted[starts]
    return starts[keep], ends[keep], code[at[starts[keep]]]


def stretch_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch of ``data`` (equal bytes, equal hash), from
    sums of powers; lengths are mixed in."""
    powers = _powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
    value = (sums[ends] - sums[starts]) * _inverse_powers(len(data))[starts]
    return mix64(value + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def _power_table(base: int, n: int, kept: dict = {}) -> np.ndarray:
    table = kept.get(base)
    if table is None or len(table) < n:
        table = np.cumprod(np.r_[np.uint64(1), np.full(max(n, 1 << 16), base, dtype=np.uint64)], dtype=np.uint64)
        if n <= 1 << 24:
            kept[base] = table
    return table[:n]


def _powers(n: int) -> np.ndarray:
    return _power_table(_BASE, n)


def _inverse_powers(n: int) -> np.ndarray:
    return _power_table(pow(_BASE, -1, 2**64), max(n, 1))


def _ordered(frame: pd.DataFrame) -> pd.DataFrame:
    """A block's rows in an order that every pass agrees on."""
    frame = frame.assign(text=frame["text"].fillna(""))
    return frame.sort_values(["doc_id", "text"], kind="stable", na_position="last").reset_index(drop=True)


def _texts(docs: DataFrame, blocks: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows with their block.  Ids travel as text, which keeps nulls and large
    ids whole; rows of one id (or none) are dealt by their texts too."""
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", block.cast("long").alias("block"), *carry)


_PASSAGES = "target int, block int, known boolean, entries binary, data binary, occurs binary"
#: A passage sent to a bucket: smallest document, anchor, length.
_ENTRY = np.dtype([("doc", np.int64), ("anchor", np.uint32), ("length", np.uint8)])
#: A place of an entry (its number in the row), and a span of a block's row.
_OCCUR = np.dtype([("entry", np.uint32), ("row", np.uint32), ("start", np.uint32)])
_SPAN = np.dtype([("row", np.uint32), ("start", np.uint32), ("end", np.uint32)])


def joined_spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans sorted by (row, start), touching ones joined."""
    if not len(row):
        return np.empty(0, dtype=_SPAN)
    order = np.lexsort((end, start, row))
    row, start, end = row[order], start[order], end[order]
    # Running end within a row: rows are kept apart by a large step.
    reach = np.maximum.accumulate(end.astype(np.int64) + (row.astype(np.int64) << 32)) - (row.astype(np.int64) << 32)
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (start[1:] > reach[:-1])])
    out = np.empty(len(new), dtype=_SPAN)
    out["row"], out["start"] = row[new], start[new]
    out["end"] = reach[np.r_[new[1:], len(row)] - 1]
    return out


def _block_passages(length: int, buckets: int, hot_list):
    """Cogrouped with a block's shared anchors: rows of passages for the
    buckets with their places, and the spans that are certain already
    (``known``): a passage of an earlier document of the block."""

    def find(key: tuple, texts: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        block = int(key[0])
        codes = [np.frombuffer(x, np.uint64) for x in shared["codes"]]
        ranked = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.uint64)
        texts = _ordered(texts)
        raws = [t.encode("utf-8") for t in texts["text"]]
        none = pd.isna(texts["doc_id"]).to_numpy()
        ids = np.array([0 if gone else int(d) for d, gone in zip(texts["doc_id"], none)], dtype=np.int64)
        parts = []
        for row, raw in enumerate(raws):
            if none[row]:
                continue
            data = np.frombuffer(raw, np.uint8)
            start, end, code = passages(data, ranked, hot_list.value, length, buckets)
            if len(start):
                parts.append((np.full(len(start), row), start, end, code, stretch_hashes(data, start, end)))
        if not parts:
            return pd.DataFrame([], columns=_COLUMNS)
        row, start, end, code, same = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((start, row, ids[row], same, code))  # the smallest document first
        row, start, end, code, same = (x[order] for x in (row, start, end, code, same))
        first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (same[1:] != same[:-1])])
        entry = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(row)]))
        later = ids[row] != ids[row[first]][entry]
        rows = []
        if later.any():
            spans = joined_spans(row[later], start[later], end[later])
            rows.append((block % buckets, block, True, b"", b"", spans.tobytes()))
        target = (mix64(code[first]) % np.uint64(buckets)).astype(np.int64)
        here = ~later
        by_target = np.argsort(target, kind="stable")
        number = np.empty(len(first), dtype=np.int64)  # of an entry within its target
        cuts = np.flatnonzero(np.r_[True, np.diff(target[by_target]) != 0])
        sizes = np.diff(np.r_[cuts, len(first)])
        number[by_target] = np.arange(len(first)) - np.repeat(cuts, sizes)
        occurs = np.empty(int(here.sum()), dtype=_OCCUR)
        occurs["entry"], occurs["row"], occurs["start"] = number[entry[here]], row[here], start[here]
        goes = target[entry[here]]
        occurs = occurs[np.argsort(goes, kind="stable")]
        ends_at = np.cumsum(np.bincount(goes, minlength=buckets))
        for a, n in zip(cuts.tolist(), sizes.tolist()):
            at = first[by_target[a : a + n]]
            held = np.empty(n, dtype=_ENTRY)
            held["doc"], held["anchor"], held["length"] = ids[row[at]], code[at] & _LOW, end[at] - start[at]
            data = b"".join([raws[r][x:y] for r, x, y in zip(row[at].tolist(), start[at].tolist(), end[at].tolist())])
            t = int(target[by_target[a]])
            places = occurs[(ends_at[t - 1] if t else 0) : ends_at[t]]
            rows.append((t, block, False, _pack(held.tobytes()), _pack(data), _pack(places.tobytes())))
        return pd.DataFrame(rows, columns=_COLUMNS)

    return find


_COLUMNS = ["target", "block", "known", "entries", "data", "occurs"]


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


# --- shard transforms and their merge --------------------------------------


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _stable_order(values: np.ndarray, most: int) -> np.ndarray:
    """Stable order of small non-negative integers: radix passes of 16 bits."""
    order = np.argsort(values.astype(np.uint16), kind="stable")
    if most >= 1 << 16:
        order = order[np.argsort((values[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def shard_order(symbols: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Suffixes of a shard ordered by their first ``length`` symbols
    (cyclically), by doubling ranks.  ``first`` ranks the first STEP symbols."""
    ranks, rank, covered = {STEP: first}, first, STEP
    while covered < length:
        add = max(w for w in ranks if covered + w <= length)
        rank = _dense(rank * (int(ranks[add].max()) + 1) + np.roll(ranks[add], -covered))
        covered += add
        ranks[covered] = rank
    return np.argsort(rank, kind="stable")


def merge_transforms(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge shard transforms by interleave refinement.

    Returns, for each place of the merged order, its shard, and the interval
    it lies in; after ``rounds`` rounds suffixes share an interval exactly
    when they agree in their first ``rounds`` steps of symbols."""
    joined = np.concatenate(transforms)
    most = int(joined.max()) if len(joined) else 0
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint16), [len(t) for t in transforms])
    interval = np.zeros(len(joined), dtype=np.int32)
    symbol = np.empty_like(joined)
    for _ in range(rounds):
        symbol[np.argsort(shard, kind="stable")] = joined  # transforms, interleaved
        order = _stable_order(symbol, most)
        shard, ranked, before = shard[order], symbol[order], interval[order]
        border = np.empty(len(order), dtype=bool)
        border[:1] = False
        border[1:] = (ranked[1:] != ranked[:-1]) | (before[1:] != before[:-1])
        interval = np.cumsum(border, dtype=np.int32)
    return shard, interval


def earliest_documents(strings: list[bytes], docs: np.ndarray, length: int, shard_size: int = SHARD) -> list[np.ndarray]:
    """For each string, the smallest document among all ``strings`` that hold
    the window at each of its places.  ``docs`` is each string's document."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    total = int(ends[-1])
    symbols = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.int64) + 1
    symbols[ends - 1] = 0  # terminators
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    left = ends[owner] - 1 - np.arange(total)  # symbols before the terminator
    # Shards are runs of whole strings.
    shard_of = (ends - sizes - 1) // shard_size
    bounds = np.r_[0, ends[np.flatnonzero(np.r_[shard_of[1:] != shard_of[:-1], True])]]
    steps = np.empty(total, dtype=np.int64)
    for a, b in zip(bounds, bounds[1:]):
        steps[a:b] = _step_codes(symbols[a:b])
    steps = _dense(steps)
    places, transforms = [], []
    for a, b in zip(bounds, bounds[1:]):
        order = shard_order(symbols[a:b], steps[a:b], length)
        places.append(order + a)
        transforms.append(steps[a + (order - STEP) % (b - a)])
    shard, interval = merge_transforms(transforms, length // STEP)
    place = np.empty(total, dtype=np.int64)
    place[np.argsort(shard, kind="stable")] = np.concatenate(places)
    doc = np.where(left[place] >= length, docs[owner[place]], np.iinfo(np.int64).max)
    first = np.flatnonzero(np.r_[True, interval[1:] != interval[:-1]])
    least = np.empty(total, dtype=np.int64)
    least[place] = np.minimum.reduceat(doc, first)[interval]
    return [least[e - n - 1 : e - length] for e, n in zip(ends.tolist(), sizes.tolist())]


def _step_codes(symbols: np.ndarray) -> np.ndarray:
    code = np.zeros(len(symbols), dtype=np.int64)
    for i in range(STEP):
        code = code * 257 + np.roll(symbols, -i)
    return code


def _bucket_spans(length: int):
    """Bucket rows to (block, spans)."""

    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        out = [(b, s) for b, s, known in zip(frame["block"], frame["occurs"], frame["known"]) if known]
        rows = frame[~frame["known"]].sort_values("block")
        if len(rows):
            entries = [np.frombuffer(_unpack(x), _ENTRY) for x in rows["entries"]]
            occurs = [np.frombuffer(_unpack(x), _OCCUR) for x in rows["occurs"]]
            base = np.cumsum([0, *map(len, entries)])
            block = np.repeat(rows["block"].to_numpy(), [len(o) for o in occurs])
            of = np.concatenate([o["entry"] + np.int64(b) for o, b in zip(occurs, base)])
            entry, occur = np.concatenate(entries), np.concatenate(occurs)
            index, start, end = lost_stretches(entry, b"".join(map(_unpack, rows["data"])), length)
            # Every place of an entry loses the entry's stretches.
            order = np.argsort(index, kind="stable")
            index, start, end = index[order], start[order], end[order]
            low, high = np.searchsorted(index, of, "left"), np.searchsorted(index, of, "right")
            count = high - low
            place = np.repeat(np.arange(len(of)), count)
            which = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count) + low[place]
            at = occur["start"][place].astype(np.int64)
            row, block = occur["row"][place], block[place]
            first, last = at + start[which], at + end[which]
            cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
            for a, b in zip(cuts, [*cuts[1:], len(block)]):
                out.append((int(block[a]), joined_spans(row[a:b], first[a:b], last[a:b]).tobytes()))
        return pd.DataFrame(out, columns=["block", "spans"])

    return judge


def lost_stretches(entries: np.ndarray, data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, start, end) of the stretches of each entry's passage whose
    windows also start in a smaller document.

    Equal passages are one string under their smallest document.  Strings that
    share their anchor with a different string go through the merge; a string
    alone with its anchor has no other occurrence than those already
    gathered."""
    sizes = entries["length"].astype(np.int64)
    ends = np.cumsum(sizes)
    symbols = np.frombuffer(data, np.uint8)
    same = stretch_hashes(symbols, ends - sizes, ends)
    order = np.lexsort((same, entries["anchor"]))
    anchor, ranked = entries["anchor"][order], same[order]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (ranked[1:] != ranked[:-1])]
    string = np.empty(len(entries), dtype=np.int64)
    string[order] = np.cumsum(new) - 1
    member = order[new]  # one entry of each string
    least = np.full(len(member), np.iinfo(np.int64).max)
    np.minimum.at(least, string, entries["doc"])
    group = entries["anchor"][member]
    alike = np.r_[False, group[1:] == group[:-1]]
    several = alike | np.r_[alike[1:], False]
    # Whole passages of strings that are alone.
    gone = np.flatnonzero(~several[string] & (least[string] < entries["doc"]))
    found = [(gone, np.zeros(len(gone), dtype=np.int64), sizes[gone])]
    # Strings are in the order of their anchors: they are merged in runs of
    # whole anchors of about MERGE symbols, which bounds what is held at once.
    entries_of = np.argsort(string, kind="stable")
    starts = np.searchsorted(string[entries_of], np.arange(len(member) + 1))
    every = np.flatnonzero(several)
    runs = np.cumsum(sizes[member[every]] + 1) // MERGE
    first = np.r_[True, group[every][1:] != group[every][:-1]][: len(every)]
    runs = runs[first][np.cumsum(first) - 1] if len(every) else runs
    for many in np.split(every, np.flatnonzero(runs[1:] != runs[:-1]) + 1) if len(every) else []:
        texts = [data[e - n : e] for e, n in zip(ends[member[many]].tolist(), sizes[member[many]].tolist())]
        earliest = earliest_documents(texts, least[many], length)
        offsets = np.cumsum([0, *map(len, earliest)])
        flat = np.concatenate(earliest)
        number = np.full(len(member), -1)
        number[many] = np.arange(len(many))
        index = np.concatenate([entries_of[starts[m] : starts[m + 1]] for m in many.tolist()])
        windows = sizes[index] - length + 1
        which = np.repeat(np.arange(len(index)), windows)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
        lost = flat[offsets[number[string[index]]][which] + offset] < entries["doc"][index][which]
        at = np.flatnonzero(lost)
        if len(at):
            cut = np.r_[True, (np.diff(at) > 1) | (which[at[1:]] != which[at[:-1]])]
            first, last = at[cut], at[np.r_[np.flatnonzero(cut)[1:], len(at)] - 1]
            found.append((index[which[first]], offset[first], offset[last] + length))
    return tuple(np.concatenate(x) for x in zip(*found))


# --- pass 3: cut the spans out ----------------------------------------------


def _cut_spans(carry: tuple[str, ...], as_text: bool):
    def cut(texts: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        texts = _ordered(texts)
        found = np.concatenate([np.empty(0, _SPAN), *[np.frombuffer(x, _SPAN) for x in spans["spans"]]])
        found = found[np.argsort(found["row"], kind="stable")]
        cuts = np.searchsorted(found["row"], np.arange(len(texts) + 1))
        rows = []
        for row, text in enumerate(texts["text"]):
            data = _bytes_of(text)
            own = found[cuts[row] : cuts[row + 1]]
            if not len(own):
                rows.append((len(data), 0, 0, data.tobytes()))
                continue
            step = np.zeros(len(data) + 2, dtype=np.int64)
            np.add.at(step, own["start"].astype(np.int64) + 1, 1)
            np.add.at(step, own["end"].astype(np.int64) + 1, -1)
            lost = np.cumsum(step)[: len(data) + 1] > 0  # one place before the text
            runs = int((lost[1:] & ~lost[:-1]).sum())
            rows.append((len(data), int(lost.sum()), runs, data[~lost[1:]].tobytes()))
        out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])
        if as_text:
            out["kept"] = out["kept"].map(lambda b: b.decode("utf-8", "ignore"))
        for c in ("doc_id", *carry):
            out[c] = texts[c]
        return out[["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *carry]]

    return cut


def remove_repeats(
    docs: DataFrame, length: int = 50, carry: tuple[str, ...] = (), as_text: bool = False
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): ``kept`` holds the
    remaining bytes of every row of ``docs``, or with ``as_text`` the
    characters that are still whole.  ``carry`` names text columns that come
    along."""
    if not ANCHOR < length <= 120 or length % STEP:
        raise ValueError(f"length must be a multiple of {STEP} between {ANCHOR} and 120")
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    blocks = max(16, (size["b"] or 0) // BLOCK_BYTES)
    buckets = max(16, (size["b"] or 0) // BUCKET_BYTES)
    hot_count = max(HOT_LEAST, int(size["n"] * HOT_SHARE))
    kind = _block_type(blocks)
    rows = _anchor_rows(_texts(docs, blocks).where("doc_id is not null"), length, buckets, kind)
    shared = write_and_read(_shared_anchors(rows, hot_count, kind), "shared_anchors")
    hot = [np.frombuffer(r["codes"], np.uint64) for r in shared.where("block = -1").collect()]
    hot_list = spark.sparkContext.broadcast(np.unique(np.concatenate(hot)) if hot else np.empty(0, np.uint64))
    # The texts are dealt to blocks once: Spark reuses the exchange for both
    # cogroups, which read the same columns.
    texts = _texts(docs, blocks, carry)
    found = texts.groupBy("block").cogroup(shared.where("block >= 0").groupBy("block")).applyInPandas(
        _block_passages(length, buckets, hot_list), _PASSAGES
    )
    spans = found.groupBy("target").applyInPandas(_bucket_spans(length), "block long, spans binary")
    carried = "".join(f", {c} string" for c in carry)
    cut = texts.groupBy("block").cogroup(spans.groupBy("block")).applyInPandas(
        _cut_spans(carry, as_text),
        f"doc_id string, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}{carried}",
    )
    return cut.withColumn("doc_id", F.col("doc_id").cast("long"))


def remove_from_documents(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, n_chars) with the repeated bytes
    gone from ``text`` and ``n_chars`` counted anew.  A character that loses
    one of its bytes goes as a whole; a null text becomes empty."""
    cut = remove_repeats(docs, length, ("lang", "source"), as_text=True)
    out = cut.select("doc_id", F.col("kept").alias("text"), "lang", "source")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
