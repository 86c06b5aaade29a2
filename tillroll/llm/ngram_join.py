"""N-gram Jaccard join with parity sketches.

A document's set is its distinct word n-grams.  Two documents link when
100 * |intersection| >= percent * |union|; the result is the set size and the
connected component of every document.

* Equal sets are one class first (grouped by a 128-bit hash of the set).
* Sizes fall into bands such that linked sets lie in one band or two
  neighbouring ones.  For each pair of neighbouring bands the tokens are dealt
  to p parts by hash; a part's parity sketch is the XOR of its tokens' hashed
  bits.  A token in one set only changes one part, so sketches of two linked
  sets differ in at most d parts, d being the largest symmetric difference
  that the sizes allow.  With more than d parts one is equal (pigeonhole):
  sets meet in a join on (band pair, part, sketch).
* Each document joins with its d + 1 fullest parts only (all parts that hold
  as many tokens as the last of them).  If two sets link, the one with the
  higher such limit has an equal part among its own, which the other has too;
  so no link is lost, and the near-empty parts that unrelated sets share stay
  out.
* Sets that met form candidate components.  Within one, every pair of sets
  not yet connected is verified: a short parity sketch bounds the symmetric
  difference from below by its Hamming distance, then the sets are
  intersected.  Components larger than a block are split: blocks are verified
  alone, then one set per class and block, level by level.
* Last, sets of different classes meet again on their join keys, which linked
  sets share, in rounds.  A round passes on the closest pair of each pair of
  classes that sizes and sketches allow (first among the classes' first sets
  under each key, then among all; 16 times as many each round after), verifies
  them and merges the classes; keys held by one class alone are out.
  The rounds end when no pair of classes had more pairs than were passed on,
  so no possible link goes unchecked, while a dense group in a few classes
  costs a few pairs.  A key with very many sets is dealt again by another
  split of their tokens.

Token identity is a 64-bit hash of the n-gram.

Cases: null and empty texts, and texts without a word, have an empty set and
link with nothing; a text with fewer words than n has one token (the whole
sequence); rows that share a doc_id are one node; rows with a null doc_id
get the component of their equal texts, or null.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tillroll.llm.common import Scratch, map_documents, mix64, record_batch, schema_of, slices
from tillroll.llm.components import connected_components
from tillroll.plans.materialize import write_and_read

#: Bytes of join keys per bucket, tokens of sets per verification block.
BUCKET_BYTES = 1 << 20
BLOCK_TOKENS = 1 << 16
#: Bits of the sketch that bounds the difference during verification, and the
#: most of the one that meets again outside the blocks.
SKETCH_BITS = 512
MOST_SKETCH_BITS = 8192
#: Sets of one join key that meet at once outside the blocks.
KEY_ROWS = 4096
#: Sub-blocks of a key beyond which its sets are dealt again.
MOST_SLOTS = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams (A-Z lower-cased)."""
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    k = min(words, len(h))
    rolled = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        rolled = mix64(rolled * _ODD + h[i : i + len(rolled)])
    return np.unique(rolled)


class Bands:
    """Size bands for a similarity of ``percent``."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]
        self.known_parts: dict[int, int] = {}

    def of(self, n: int) -> int:
        """Band of size ``n``: partners of a band's smallest size stay in the
        band, those of its largest reach the next at most."""
        while self.low[-1] <= n:
            self.low.append(100 * self.low[-1] // self.percent + 1)
        return bisect_right(self.low, n) - 1

    def difference(self, a: int, b: int) -> int:
        """Largest symmetric difference of linked sets of sizes a and b."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def roles(self, n: int) -> Iterator[tuple[int, int]]:
        """(band pair, differing parts allowed) in which a set of size ``n``
        joins.  Without room for a difference only equal sets link, which are
        one class already."""
        band = self.of(n)
        d = self.difference(n, 100 * n // self.percent)
        if d:
            yield band, d
        if band:
            largest = self.low[band] - 1
            if 100 * largest >= self.percent * n:
                d = self.difference(n, largest)
                if d:
                    yield band - 1, d

    def parts(self, pair: int) -> int:
        """Number of parts of a band pair: half as many again as could differ."""
        if pair not in self.known_parts:
            while len(self.low) < pair + 3:
                self.of(self.low[-1])
            low, high = self.low[pair + 1] - 1, self.low[pair + 2] - 1
            most = max(self.difference(low, 100 * low // self.percent), self.difference(high, low))
            self.known_parts[pair] = (most + 1) * 3 // 2
        return self.known_parts[pair]


def part_keys(tokens: np.ndarray, bands: Bands) -> np.ndarray:
    """Join keys of one set: a 64-bit hash of (band pair, part, sketch)."""
    found = []
    for pair, d in bands.roles(len(tokens)):
        p = bands.parts(pair)
        part = (mix64(tokens + np.uint64(pair)) % np.uint64(p)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        ranked = part[order]
        starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        sketch = np.bitwise_xor.reduceat(tokens[order], starts)
        filled = np.diff(np.r_[starts, len(tokens)])
        numbers = ranked[starts]
        if len(starts) <= d:  # empty parts are needed too
            full = np.zeros(p, dtype=np.uint64)
            full[numbers] = sketch
            numbers, sketch = np.arange(p), full
        else:
            least = np.partition(filled, len(filled) - d - 1)[len(filled) - d - 1]
            numbers, sketch = numbers[filled >= least], sketch[filled >= least]
        salt = np.uint64((pair + 1) * int(_ODD) % 2**64) + numbers.astype(np.uint64)
        found.append(mix64(mix64(salt) ^ sketch))
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def set_classes(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_hash); the hash is null for an empty set."""

    def run(cols: dict) -> dict:
        sets = [shingle_hashes(t, words) for t in cols["text"]]
        return {
            "doc_id": cols["doc_id"],
            "n_shingles": [len(s) for s in sets],
            "set_hash": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
        }

    return map_documents(docs, run, schema_of("doc_id long, n_shingles long, set_hash binary"), ["doc_id", "text"])


def _key_blobs(docs: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    """(bucket, keys, low, ids, met): the join keys of each task's distinct
    sets, packed per bucket: 32 bits of each key (the bucket holds the rest of
    what tells keys apart) and its id, less the row's lowest id, in 4 bytes
    where that fits.  Equal sets within a task join once, under their first
    id.  Sets that share a key within a task have met: their pairs with the
    key's least id travel in ``met``, and only that id goes on with the key."""
    schema = schema_of("bucket int, keys binary, low long, ids binary, met binary")
    arrow = to_arrow_schema(schema)

    def flush(keys: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        k, i = np.concatenate(keys), np.concatenate(ids)
        order = np.lexsort((i, k))
        k, i = k[order], i[order]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        least = np.repeat(i[first], np.diff(np.r_[first, len(i)]))
        apart = least != i
        met = np.unique(np.stack([least[apart], i[apart]], axis=1), axis=0)
        k, i = k[first], i[first]
        bucket = ((k >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        k, i, bucket = k[order].astype(np.uint32), i[order], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[cuts[1:], len(k)]
        low = np.minimum.reduceat(i, cuts)
        past = i - np.repeat(low, ends - cuts)
        past = past.astype(np.uint32) if past.max() < 1 << 32 else past
        # The pairs ride along with the rows, a share with each.
        shares = np.array_split(met, len(cuts))
        return record_batch(
            {
                "bucket": bucket[cuts].astype(np.int32),
                "keys": [k[a:b].tobytes() for a, b in zip(cuts, ends)],
                "low": low,
                "ids": [past[a:b].tobytes() for a, b in zip(cuts, ends)],
                "met": [x.astype(np.int64).tobytes() for x in shares],
            },
            arrow,
        )

    def run(batches):
        bands, seen = Bands(percent), set()
        keys, ids, held = [], [], 0
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    tokens = shingle_hashes(text, words)
                    if doc_id is None or not len(tokens):
                        continue
                    mark = xxhash.xxh3_128_digest(tokens.tobytes())
                    if mark in seen:
                        continue
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(mark)
                    found = part_keys(tokens, bands)
                    keys.append(found)
                    ids.append(np.full(len(found), doc_id, dtype=np.int64))
                    held += len(found)
                    if held > 1_000_000:
                        yield flush(keys, ids)
                        keys, ids, held = [], [], 0
        if held:
            yield flush(keys, ids)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _meetings(blobs: DataFrame) -> DataFrame:
    """(a, b): sets that share a key, each with the smallest id of the key."""

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(x, np.uint32) for x in frame["keys"]])
        ids = np.concatenate(
            [
                np.frombuffer(x, np.uint32 if len(x) == len(k) else np.int64).astype(np.int64) + low
                for k, low, x in zip(frame["keys"], frame["low"], frame["ids"])
            ]
        )
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        least = np.repeat(ids[first], np.diff(np.r_[first, len(ids)]))
        differ = least != ids
        known = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in frame["met"]]
        pairs = np.unique(np.concatenate([np.stack([least[differ], ids[differ]], axis=1), *known]), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return blobs.groupBy("bucket").applyInPandas(meet, "a long, b long")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """``SKETCH_BITS`` bits; each token flips one of them."""
    bit = (mix64(tokens) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(bit, minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


class Verifier:
    """Sets of one block with what the filters need."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.sketches = np.stack([parity_sketch(s) for s in sets])

    def possible(self, i: int, others: np.ndarray) -> np.ndarray:
        """Of ``others``, those whose size and sketch allow a link with i."""
        n, m = self.sizes[i], self.sizes[others]
        p = self.percent
        others = others[(100 * np.minimum(n, m) >= p * np.maximum(n, m))]
        apart = np.bitwise_count(self.sketches[others] ^ self.sketches[i]).sum(axis=1)
        return others[apart * (100 + p) <= (n + self.sizes[others]) * (100 - p)]

    def links(self, i: int, others: np.ndarray, root: np.ndarray) -> None:
        """Verify i against ``others``, merging classes in ``root``; pairs
        already in one class are skipped."""
        others = self.possible(i, others[root[others] != root[i]])
        for j in others.tolist():
            if root[j] != root[i] and _linked(self.sets[i], self.sets[j], self.percent):
                a, b = int(root[i]), int(root[j])
                root[root == max(a, b)] = min(a, b)


def cluster(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Class of each set: exact connectivity among all of them."""
    v = Verifier(sets, percent)
    root = np.arange(len(sets))
    for i in range(1, len(sets)):
        v.links(i, np.arange(i), root)
    return root


_MEMBER = "doc_id long, root long, tokens binary"


def _verify_blocks(members: DataFrame, percent: int) -> DataFrame:
    """Exact classes within each (block, component): (component, doc_id, root,
    tokens), where only a class's root row carries its tokens on."""

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        frame = frame.sort_values(["component", "doc_id"], kind="stable")
        for component, part in frame.groupby("component", sort=False):
            ids = part["doc_id"].to_numpy()
            root = cluster([np.frombuffer(t, np.uint64) for t in part["tokens"]], percent)
            top = root == np.arange(len(root))
            tokens = [t if lead else None for t, lead in zip(part["tokens"], top)]
            out.append(pd.DataFrame({"component": component, "doc_id": ids, "root": ids[root], "tokens": tokens}))
        return pd.concat(out)

    return members.groupBy("block").applyInPandas(verify, f"component long, {_MEMBER}")


def _pieces(sizes: DataFrame, block_tokens: int) -> DataFrame:
    """Adds the number of blocks of each component by its ``tokens``."""
    return sizes.withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long"))


def _with_block(members: DataFrame, shared: int, level: int) -> DataFrame:
    """Components of one piece share blocks by their hash; a larger one has
    its own blocks, members dealt by their hash."""
    own = F.xxhash64("component", F.pmod(F.xxhash64("doc_id", F.lit(level)), F.col("pieces")))
    block = F.when(F.col("pieces") > 1, own).otherwise(F.pmod(F.xxhash64("component"), F.lit(shared)))
    return members.withColumn("block", block)


def verified_links(members: DataFrame, percent: int, shared: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Edges (a, b) that connect exactly the linked sets of ``members``
    (component, pieces, doc_id, tokens; a written table) within each block,
    then among the classes' first sets, level by level."""
    scratch = Scratch(members.sparkSession)
    level, current, links, before = 0, members, None, None
    while True:
        done = scratch.write(_verify_blocks(_with_block(current, shared, level), percent), "join_verified")
        found = done.where("doc_id <> root").select(F.col("doc_id").alias("a"), F.col("root").alias("b"))
        links = found if links is None else links.union(found)
        # Roots of split components go on to the next level.
        split = current.where("pieces > 1").select("component").distinct()
        roots = done.where("tokens is not null").join(split, "component", "left_semi")
        roots = scratch.write(roots.select("component", "doc_id", "tokens"), "join_roots")
        count = (F.octet_length("tokens") / 8).cast("long")
        sizes = _pieces(roots.groupBy("component").agg(F.sum(count).alias("tokens")), block_tokens)
        sizes = scratch.write(sizes.drop("tokens"), "join_sizes")
        left = sizes.agg(F.sum("pieces")).first()[0] or 0
        # A level that hardly shrinks would only repeat: the last round checks
        # all that is still apart.
        if not left or (before is not None and left * 2 > before):
            break
        before = left
        current = scratch.write(roots.join(sizes, "component"), "join_level")
        shared, level = max(1, left), level + 1
    links = write_and_read(links, "join_links")
    scratch.drop()
    return links


def wide_sketch(tokens: np.ndarray) -> bytes:
    """Parity sketch of eight bits or more a token (a power of two between
    ``SKETCH_BITS`` and ``MOST_SKETCH_BITS``), so that unlike sets still
    differ in it.  The XOR of its halves is the sketch of half the width."""
    bits = min(MOST_SKETCH_BITS, max(SKETCH_BITS, 1 << (8 * len(tokens) - 1).bit_length()))
    bit = (mix64(tokens) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _same_width(sketches: list[bytes]) -> np.ndarray:
    """Sketches folded to the narrowest of them."""
    width = min(map(len, sketches)) // 8
    out = []
    for one in sketches:
        words = np.frombuffer(one, np.uint64)
        while len(words) > width:
            words = words[: len(words) // 2] ^ words[len(words) // 2 :]
        out.append(words)
    return np.stack(out)


class _Closest:
    """The ``limit`` closest pairs of every pair of labels; ``more`` are the
    label pairs that had further ones."""

    def __init__(self, limit: int):
        self.limit, self.rows, self.waiting, self.size = limit, np.empty((0, 5), dtype=np.int64), [], 0
        self.more: set[tuple[int, int]] = set()

    def add(self, rows: np.ndarray) -> None:
        """Rows of (lower label, higher label, closeness, a, b)."""
        self.waiting.append(rows)
        self.size += len(rows)
        if self.size > 200_000:
            self.settle()

    def settle(self) -> np.ndarray:
        rows = np.unique(np.concatenate([self.rows, *self.waiting]), axis=0)  # sorted, repeats go
        head = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)][: len(rows)]
        start = np.flatnonzero(head)
        place = np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))
        self.more.update(map(tuple, rows[place == self.limit, :2].tolist()))
        self.rows, self.waiting, self.size = rows[place < self.limit], [], 0
        return self.rows


def _possible_pairs(ids, labels, sizes, sketches, percent: int, found: _Closest) -> None:
    """Adds the pairs of different labels whose sizes and sketches allow a
    link.  Closeness is the Hamming distance less what a link allows."""
    sketches = _same_width(sketches)
    names, count = np.unique(labels, return_counts=True)
    hosts = labels == names[np.argmax(count)]  # one label: none of its pairs is open
    order = np.r_[np.flatnonzero(hosts), np.flatnonzero(~hosts)]
    for at in range(int(hosts.sum()), len(order)):
        i, others = order[at], order[:at]
        n, m = sizes[i], sizes[others]
        fits = (labels[others] != labels[i]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
        others = others[fits]
        apart = np.bitwise_count(sketches[others] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        slack = apart * (100 + percent) - (n + sizes[others]) * (100 - percent)
        others, slack = others[slack <= 0], slack[slack <= 0]
        if len(others):
            own = np.full(len(others), ids[i]), np.full(len(others), labels[i])
            swap = labels[others] < own[1]
            a, b = np.where(swap, ids[others], own[0]), np.where(swap, own[0], ids[others])
            low, high = np.minimum(labels[others], own[1]), np.maximum(labels[others], own[1])
            found.add(np.stack([low, high, slack, a, b], axis=1))


_PAIRS = "label_a long, label_b long, closeness long, a long, b long, more boolean"


class OpenSets:
    """Sets that may link across classes, with their join keys.

    ``members`` are (doc_id, tokens); a key held by more than ``key_rows``
    sets meets in pairs of sub-blocks, and one of more than ``slots`` such
    blocks is split by the join keys of a second, independent dealing of its
    sets' tokens (which linked sets share as well), until none is left or the
    next dealing tells no more apart."""

    def __init__(self, members: DataFrame, percent: int, key_rows: int = KEY_ROWS, slots: int = MOST_SLOTS):
        self.scratch = Scratch(members.sparkSession)
        self.percent, self.key_rows, self.slots = percent, key_rows, slots
        schema = schema_of("doc_id long, n long, sketch binary, keys array<long>")
        arrow = to_arrow_schema(schema)

        def to_keys(batches):
            bands = Bands(percent)
            for batch in batches:
                for part in slices(batch, "tokens"):
                    sets = [np.frombuffer(t, np.uint64) for t in part.column("tokens").to_pylist()]
                    yield record_batch(
                        {
                            "doc_id": part.column("doc_id").to_pylist(),
                            "n": [len(s) for s in sets],
                            "sketch": [wide_sketch(s) for s in sets],
                            "keys": [np.unique(part_keys(s, bands)).view(np.int64) for s in sets],
                        },
                        arrow,
                    )

        self.members = members.select("doc_id", "tokens")
        self.sets = self.scratch.write(self.members.mapInArrow(to_keys, schema), "join_open_sets")

    def _mixed(self, keys: DataFrame) -> DataFrame:
        """(key, slots) of the keys that more than one class holds."""
        held = keys.groupBy("key").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.ceil(F.count("*") / self.key_rows).alias("slots")
        )
        return held.where("low <> high").select("key", "slots")

    def _split_again(self, crowd: DataFrame, turn: int) -> DataFrame:
        """(key, doc_id, label): the rows of ``crowd`` (key, doc_id, label)
        under keys of another dealing."""
        percent = self.percent

        def again(cols: dict) -> dict:
            bands, out = Bands(percent), {"key": [], "doc_id": [], "label": []}
            turn_salt = np.uint64(mix64(np.array([turn], dtype=np.uint64))[0])
            for key, doc_id, label, tokens in zip(cols["key"], cols["doc_id"], cols["label"], cols["tokens"]):
                keys = np.unique(part_keys(mix64(np.frombuffer(tokens, np.uint64) ^ turn_salt), bands))
                keys = mix64(keys ^ np.int64(key).view(np.uint64)).view(np.int64)
                out["key"].append(keys)
                out["doc_id"].append(np.full(len(keys), doc_id, dtype=np.int64))
                out["label"].append(np.full(len(keys), label, dtype=np.int64))
            return {c: np.concatenate([np.empty(0, dtype=np.int64), *v]) for c, v in out.items()}

        sent = crowd.join(self.members, "doc_id").select("key", "doc_id", "label", "tokens")
        return map_documents(sent, again, schema_of("key long, doc_id long, label long"), sent.columns, "tokens")

    def meetings(self, labels: DataFrame, first: bool = False) -> DataFrame:
        """(key, slots, doc_id, label): the sets of the keys to compare on
        (with ``first`` only the first of each key and class)."""
        keys = self.sets.join(labels, "doc_id").select(F.explode("keys").alias("key"), "doc_id", "label")
        if first:
            keys = keys.groupBy("key", "label").agg(F.min("doc_id").alias("doc_id")).select("key", "doc_id", "label")
        met, turn, before = None, 0, None
        while True:
            here = self.scratch.write(keys.join(self._mixed(keys), "key"), "join_met")
            crowd = here.where(F.col("slots") > self.slots)
            hot = crowd.agg(F.max("slots")).first()[0]
            # A crowd that another dealing does not thin out consists of near
            # copies: it meets as it is.
            last = hot is None or (before is not None and 2 * hot > before)
            cold = here if last else here.where(F.col("slots") <= self.slots)
            met = cold if met is None else met.unionByName(cold)
            if last:
                return met
            before, turn = hot, turn + 1
            keys = self._split_again(crowd.select("key", "doc_id", "label"), turn)

    def pairs(self, labels: DataFrame, limit: int) -> DataFrame:
        """(label_a, label_b, closeness, a, b, more): of every two classes
        whose sets meet and may link, the ``limit`` closest pairs or more;
        with ``limit`` 0 the closest one if each key's classes are met by
        their first set only."""
        percent, key_rows = self.percent, self.key_rows
        met = self.meetings(labels, first=limit == 0)
        limit = max(1, limit)
        slot = F.pmod(F.xxhash64("doc_id"), F.col("slots"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1))
        met = met.withColumn("slot", slot).withColumn("other", other)
        # (key, pair of slots): hashed to one number, which also deals the groups.
        group = F.xxhash64("key", F.least("slot", "other"), F.greatest("slot", "other"))
        buckets = max(1, met.count() // key_rows)
        dealt = met.select(group.alias("meeting"), "doc_id", "label").join(self.sets.drop("keys"), "doc_id")
        dealt = dealt.withColumn("bucket", F.pmod("meeting", F.lit(buckets)))

        def meet(frame: pd.DataFrame) -> pd.DataFrame:
            found = _Closest(limit)
            for _, part in frame.groupby("meeting", sort=False):
                ids, labels_ = part["doc_id"].to_numpy(), part["label"].to_numpy()
                if (labels_ != labels_[0]).any():
                    _possible_pairs(ids, labels_, part["n"].to_numpy(), part["sketch"].tolist(), percent, found)
            out = pd.DataFrame(found.settle(), columns=["label_a", "label_b", "closeness", "a", "b"])
            return out.assign(more=[p in found.more for p in zip(out["label_a"].tolist(), out["label_b"].tolist())])

        pairs = dealt.groupBy("bucket").applyInPandas(meet, _PAIRS)
        if limit == 1:
            # The closest of all meetings, by a two-phase aggregate.
            best = F.min(F.struct("closeness", "a", "b")).alias("best")
            others = (F.bool_or("more") | (F.min(F.struct("a", "b")) != F.max(F.struct("a", "b")))).alias("more")
            pairs = pairs.groupBy("label_a", "label_b").agg(best, others)
            pairs = pairs.select("label_a", "label_b", "best.closeness", "best.a", "best.b", "more")
        return pairs.distinct()


def _verify_pairs(pairs: DataFrame, members: DataFrame, percent: int, block_tokens: int) -> DataFrame:
    """Edges (a, b): the linked of ``pairs``.  Pairs are dealt by blocks of
    ids on both sides, so a set travels once to a block that needs it."""
    scratch = Scratch(members.sparkSession)
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = scratch.write(members.select("doc_id", "tokens").join(ends, "doc_id"), "join_pair_sets")
    weight = (F.octet_length("tokens") / 8).cast("long")
    side = (sets.agg(F.sum(weight)).first()[0] or 0) // block_tokens + 1
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(side))
    pairs = pairs.withColumn("block", place("a") * F.lit(side) + place("b"))
    needs = pairs.select("block", F.col("a").alias("doc_id")).union(pairs.select("block", "b")).distinct()
    total = needs.join(sets.groupBy("doc_id").agg(F.sum(weight).alias("n")), "doc_id").agg(F.sum("n")).first()[0]
    buckets = (total or 0) // (2 * block_tokens) + 1
    bucket = F.pmod(F.xxhash64("block"), F.lit(buckets))
    pairs = pairs.withColumn("bucket", bucket).drop("block")
    sent = needs.withColumn("bucket", bucket).select("bucket", "doc_id").distinct().join(sets, "doc_id")

    def verify(wanted: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        held: dict[int, list[np.ndarray]] = {}
        for i, t in zip(found["doc_id"].tolist(), found["tokens"]):
            held.setdefault(i, []).append(np.frombuffer(t, np.uint64))
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        edges = []
        for a, b, la, lb in wanted[["a", "b", "label_a", "label_b"]].itertuples(index=False):
            la, lb = top(la), top(lb)
            if la != lb and any(_linked(x, y, percent) for x in held[a] for y in held[b]):
                root[max(la, lb)] = min(la, lb)
                edges.append((a, b))
        return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")

    edges = pairs.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInPandas(verify, "a long, b long")
    edges = write_and_read(edges, "join_rest")
    scratch.drop()
    return edges


def _last_round(members: DataFrame, links: DataFrame, percent: int, block_tokens: int) -> DataFrame | None:
    """Edges between sets of split components that are still in different
    classes.  Linked sets share a join key, so only sets that meet again on
    one are compared: closest first, merging classes round by round."""
    split = members.where("pieces > 1").select("component", "doc_id")
    if split.isEmpty():
        return None
    labels = connected_components(links)
    named = split.join(labels.toDF("doc_id", "label"), "doc_id", "left").withColumn(
        "label", F.coalesce("label", "doc_id")
    )
    apart = named.groupBy("component").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    labels = named.join(apart.where("low <> high"), "component").select("doc_id", "label").distinct()
    labels = write_and_read(labels, "join_open")
    if labels.isEmpty():
        return None
    members = members.where("pieces > 1").select("doc_id", "tokens")
    sets = OpenSets(members.join(labels.select("doc_id"), "doc_id", "left_semi"), percent)
    edges, limit = None, 0
    while True:
        pairs = write_and_read(sets.pairs(labels, limit), "join_open_pairs")
        if pairs.isEmpty() and limit:
            break
        found = _verify_pairs(pairs, members, percent, block_tokens)
        edges = found if edges is None else edges.union(found)
        # Classes that a verified pair joins are one from now on.
        ends = found.join(pairs, ["a", "b"]).select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        merged = connected_components(ends).toDF("label", "top")
        labels = labels.join(merged, "label", "left").select("doc_id", F.coalesce("top", "label").alias("label"))
        labels = write_and_read(labels, "join_open")
        if limit == 0:  # all classes meet again, by all their sets
            limit = 1
            continue
        rest = pairs.where("more").select("label_a", "label_b").distinct()
        rest = rest.join(merged.toDF("label_a", "top_a"), "label_a", "left").join(
            merged.toDF("label_b", "top_b"), "label_b", "left"
        )
        rest = rest.where(F.coalesce("top_a", "label_a") != F.coalesce("top_b", "label_b"))
        rest = rest.select(F.coalesce("top_a", "label_a").alias("u"), F.coalesce("top_b", "label_b").alias("v"))
        if (rest := write_and_read(rest, "join_rest_labels")).isEmpty():
            break
        # Only classes that had further pairs meet again.
        open_ = rest.select(F.col("u").alias("label")).union(rest.select("v")).distinct()
        labels = write_and_read(labels.join(open_, "label", "left_semi"), "join_open")
        limit *= 16
    sets.scratch.drop()
    return edges


def jaccard_components(
    docs: DataFrame, words: int = 5, percent: int = 80, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    classes = write_and_read(set_classes(docs, words), "join_classes")
    tokens = classes.agg(F.sum("n_shingles")).first()[0] or 0
    # About 0.6 keys a token at 80 percent, 8 bytes each.
    share = (100 - percent) / percent * 2.5
    buckets = max(32, int(tokens * share * 8 / BUCKET_BYTES))
    met = _meetings(_key_blobs(docs, words, percent, buckets)).distinct()
    candidates = connected_components(met).toDF("doc_id", "component")
    weights = classes.groupBy("doc_id").agg(F.sum("n_shingles").alias("n"))
    weighed = write_and_read(candidates.join(weights, "doc_id"), "join_candidates")
    sizes = _pieces(weighed.groupBy("component").agg(F.sum("n").alias("tokens")), block_tokens)
    shared = max(1, (weighed.agg(F.sum("n")).first()[0] or 0) // block_tokens)
    component = weighed.join(sizes.drop("tokens"), "component").select("doc_id", "component", "pieces")

    def to_tokens(cols: dict) -> dict:
        return {**cols, "tokens": [shingle_hashes(t, words).tobytes() for t in cols["text"]]}

    # Texts are dealt by id (a merge join at every size).
    sets = map_documents(
        docs.select("doc_id", "text").join(component.hint("merge"), "doc_id"),
        to_tokens,
        schema_of("component long, pieces long, doc_id long, tokens binary"),
        ["component", "pieces", "doc_id", "text"],
    ).where(F.octet_length("tokens") > 0)
    scratch = Scratch(docs.sparkSession)
    members = scratch.write(sets, "join_sets")
    links = verified_links(members, percent, shared, block_tokens)
    rest = _last_round(members, links, percent, block_tokens)
    if rest is not None:
        links = links.union(rest)
    scratch.drop()

    # Classes of equal sets are nodes: their smallest id stands for them.
    reps = classes.where("set_hash is not null").groupBy("set_hash").agg(F.min("doc_id").alias("rep"))
    ends = classes.select("doc_id", "set_hash").join(
        links.select(F.col("a").alias("doc_id")).union(links.select("b")).distinct(), "doc_id"
    )
    known = write_and_read(ends.join(reps, "set_hash").select("doc_id", "rep").distinct(), "join_ends")
    edges = links.join(known.toDF("a", "rep_a"), "a").join(known.toDF("b", "rep_b"), "b")
    # Rows that share an id tie their classes together.
    ties = known.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    all_edges = edges.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).union(ties.select("a", "b"))
    labels = connected_components(all_edges).toDF("rep", "component")
    named = reps.join(labels, "rep", "left").select("set_hash", F.coalesce("component", "rep").alias("component_id"))
    return classes.join(named, "set_hash", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_representatives(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component.

    Rows that share a doc_id are one document: the one with the smallest text
    stays.  Rows with a null doc_id are in no group and stay."""
    groups = jaccard_components(docs, words, percent)
    lost = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(lost, "doc_id", "left_anti")
    repeated = write_and_read(
        docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "join_repeated"
    )
    if repeated.isEmpty():
        return kept
    rest = [c for c in docs.columns if c != "doc_id"]
    first = F.min(F.struct("text", *[c for c in rest if c != "text"])).alias("row")
    one = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(first)
    return kept.join(repeated, "doc_id", "left_anti").unionByName(one.select("doc_id", *[f"row.{c}" for c in rest]))
