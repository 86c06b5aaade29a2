"""Alignment of two tokenizations of the same bytes.

Tokenizer A (byte-level BPE, a tokenizers JSON) reads a space and the text,
tokenizer B (a sentencepiece model) the text, to which it adds that space
itself.  Byte places where a token of A and a token of B both end cut the
tokens into groups; every A token of a group is linked with every B token of
it.  A link's count is the number of documents of the corpus that hold its id
pair linked; a link is best if no other pair of its A id has a higher count.

* The token ends of a slice of documents are two sorted sequences.  Their
  merge is divided on its merge path: a binary search along each diagonal
  finds where a piece of ``work`` ends begins in A and in B, so pieces are
  independent and equal in work.  A piece finds the common ends in it and
  numbers its groups from 0 (its first may have begun in the piece before, its
  last may go on); an exclusive sum of the pieces' common ends stitches them.
* Each document's distinct id pairs, with how many links each has, are
  written once.  Pairs are counted per task first, then by Spark.
* Of R rows (document, pair), at most ``most_pairs`` pairs can be in
  R / ``most_pairs`` documents or more: those are broadcast, whatever the
  corpus' size.  Rows of the others, none of which is hot, join their counts
  by pair.

Cases: a text that is null or empty, or for which the joined token bytes of A
or of B differ from space and text (normalised by the model, say), has no
tokens: its numbers are 0 and ``groups`` is the empty text.  Special tokens'
strings inside texts are plain text.  Rows that repeat count as a document
each; doc_ids may be null or repeated (rows have a key of their own).  A
group's pairs are formed from its distinct ids and their numbers.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tillroll.llm.bpe import byte_alphabet
from tillroll.llm.common import Scratch, file_bytes, map_documents, record_batch, schema_of, slices
from tillroll.plans.materialize import write_and_read

#: Text tokenized and aligned at once.
SLICE_BYTES = 2 << 20
#: Token ends of a merge piece.
WORK = 1 << 15
#: Pairs broadcast at most.
MOST_PAIRS = 1_000_000
#: Links of a group formed pair by pair; larger groups by their distinct ids.
PLAIN_LINKS = 1 << 12
#: Fixed value: the pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space that the compiled pattern cannot take in one run.
_LONG_SPACE = re.compile(r"\s{5000}")


class ByteTokens:
    """Ids and token bytes of a byte-level BPE vocabulary (tokenizers JSON).
    Its merges run in tiktoken, which gives the library's ids; texts with very
    long runs of white space go through the library."""

    def __init__(self, data: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(data)
        byte_of = {c: b for b, c in byte_alphabet().items()}
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if i not in special
        }
        self.bytes_of = [b""] * (1 + max([*ranks.values(), *special]))
        for t, i in ranks.items():
            self.bytes_of[i] = t
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_str(data.decode("utf-8"))
        self.library.encode_special_tokens = True
        self.library.no_padding()
        self.library.no_truncation()

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            text = " " + text
            if len(text) >= 5000 and _LONG_SPACE.search(text):
                found = self.library.encode(text, add_special_tokens=False).ids
            else:
                found = self.fast.encode_to_numpy(text, disallowed_special=())
            out.append(np.asarray(found, dtype=np.int64))
        return out


class PieceTokens:
    """Ids and token bytes of a sentencepiece model."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.bytes_of = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            plain = piece.replace("▁", " ").encode("utf-8")
            self.bytes_of.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else plain)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.model.encode(texts, num_threads=1)
        flat = np.fromiter(itertools.chain.from_iterable(found), dtype=np.int64, count=sum(map(len, found)))
        return np.split(flat, np.cumsum([len(x) for x in found])[:-1]) if found else []


def merge_path(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces of ``work`` elements of the merge of sorted ``a`` and
    ``b`` (of equal values a's first) begin and end in each: a binary search
    along every diagonal, all at once."""
    total = len(a) + len(b)
    diagonal = np.r_[np.arange(0, total, work), total]
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        first = a[middle] <= b[diagonal[open_] - 1 - middle]
        low[open_] = np.where(first, middle + 1, low[open_])
        high[open_] = np.where(first, high[open_], middle)
    return low, diagonal - low


def group_numbers(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each token, from the strictly ascending token ends of
    A and B: the number of common ends before the token's own end."""
    at_a, at_b = merge_path(a, b, work)
    group_a, group_b = np.empty(len(a), dtype=np.int64), np.empty(len(b), dtype=np.int64)
    closed = []
    pieces = list(zip(at_a[:-1].tolist(), at_a[1:].tolist(), at_b[:-1].tolist(), at_b[1:].tolist()))
    for i, i2, j, j2 in pieces:  # independent of each other
        own_a, own_b = a[i:i2], b[j:j2]
        near = np.searchsorted(own_b, own_a)
        common = near < len(own_b)
        common[common] = own_b[near[common]] == own_a[common]
        ends = own_a[common]
        if j < j2 and i and a[i - 1] == own_b[0]:  # its A side ended the piece before
            ends = np.r_[own_b[0], ends]
        group_a[i:i2] = np.searchsorted(ends, own_a)
        group_b[j:j2] = np.searchsorted(ends, own_b)
        closed.append(len(ends))
    before = 0
    for (i, i2, j, j2), n in zip(pieces, closed):  # stitch
        group_a[i:i2] += before
        group_b[j:j2] += before
        before += n
    return group_a, group_b


class Aligned:
    """Tokens, groups and links of several texts."""

    def __init__(self, a, b, texts: list[str | None], work: int = WORK):
        none = np.empty(0, dtype=np.int64)
        found_a, found_b = [none] * len(texts), [none] * len(texts)
        some = [k for k, t in enumerate(texts) if t]
        plain = [texts[k] for k in some]
        data = [b" " + t.encode("utf-8") for t in plain]
        ids_a, ids_b = a.ids(plain), b.ids(plain)
        for k, x, y, p, q in zip(some, ids_a, ids_b, _same_bytes(a, ids_a, data), _same_bytes(b, ids_b, data)):
            if p and q:
                found_a[k], found_b[k] = x, y
        self.texts = len(texts)
        self.n_a = np.array([len(x) for x in found_a], dtype=np.int64)
        self.n_b = np.array([len(x) for x in found_b], dtype=np.int64)
        self.ids_a = np.concatenate([none, *found_a])
        self.ids_b = np.concatenate([none, *found_b])
        self.group_a, self.group_b = group_numbers(
            np.cumsum(_sizes(a)[self.ids_a]), np.cumsum(_sizes(b)[self.ids_b]), work
        )
        # Tokens of each group on both sides, and the text it stands in.
        groups = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        self.in_a = np.bincount(self.group_a, minlength=groups)
        self.in_b = np.bincount(self.group_b, minlength=groups)
        text_a = np.repeat(np.arange(self.texts), self.n_a)
        self.first_a = np.cumsum(self.in_a) - self.in_a
        self.first_b = np.cumsum(self.in_b) - self.in_b
        self.text = text_a[self.first_a]
        self.n_groups = np.bincount(self.text, minlength=self.texts)
        self.n_links = np.bincount(self.text, weights=self.in_a * self.in_b, minlength=self.texts).astype(np.int64)

    def pairs(self, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, A id * size_b + B id, links): the distinct id pairs of each
        text, by text and pair."""
        links = self.in_a * self.in_b
        plain = links <= PLAIN_LINKS
        small = np.flatnonzero(plain[self.group_a])  # A tokens
        group = self.group_a[small]
        each = self.in_b[group]
        row = np.repeat(np.arange(len(small)), each)
        place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        other = self.first_b[group][row] + place
        texts = [self.text[group][row]]
        keys = [self.ids_a[small][row] * size_b + self.ids_b[other]]
        times = [np.ones(len(row), dtype=np.int64)]
        for g in np.flatnonzero(~plain).tolist():
            ua, ca = np.unique(self.ids_a[self.first_a[g] : self.first_a[g] + self.in_a[g]], return_counts=True)
            ub, cb = np.unique(self.ids_b[self.first_b[g] : self.first_b[g] + self.in_b[g]], return_counts=True)
            keys.append((ua[:, None] * size_b + ub).ravel())
            times.append((ca[:, None] * cb).ravel())
            texts.append(np.full(len(keys[-1]), self.text[g]))
        text, key, n = map(np.concatenate, (texts, keys, times))
        # One sort of (text, pair), equal rows summed.
        span = int(key.max(initial=0)) + 1
        whole = text * span + key
        if len(keys) == 1:
            whole = np.sort(whole)
            head = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]][: len(whole)])
            n = np.diff(np.r_[head, len(whole)])
        else:
            order = np.argsort(whole, kind="stable")
            whole, n = whole[order], n[order]
            head = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]][: len(whole)])
            n = np.add.reduceat(n, head)
        return whole[head] // span, whole[head] % span, n

    def listings(self, names_a: np.ndarray, names_b: np.ndarray) -> Iterator[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text; ``names_*`` hold the decimal
        ids followed by the mark within and at the end of a group."""
        last_a = (np.r_[self.group_a[1:] != self.group_a[:-1], True][: len(self.group_a)]).astype(np.int64)
        last_b = (np.r_[self.group_b[1:] != self.group_b[:-1], True][: len(self.group_b)]).astype(np.int64)
        line = np.empty(len(self.ids_a) + len(self.ids_b), dtype=object)
        line[np.arange(len(self.ids_a)) + self.first_b[self.group_a]] = names_a[self.ids_a, last_a]
        after = self.first_a + self.in_a
        line[np.arange(len(self.ids_b)) + after[self.group_b]] = names_b[self.ids_b, last_b]
        line = line.tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        for start, end in zip([0, *ends], ends):
            yield b"".join(line[start:end])[:-1]


def _same_bytes(side, ids: list[np.ndarray], data: list[bytes]) -> list[bool]:
    """Whether the joined token bytes of each text are its ``data``: all texts
    at once, one by one only if they differ."""
    every = np.concatenate([np.empty(0, dtype=np.int64), *ids]).tolist()
    sizes = all(int(_sizes(side)[x].sum()) == len(d) for x, d in zip(ids, data))
    if sizes and b"".join(map(side.bytes_of.__getitem__, every)) == b"".join(data):
        return [True] * len(data)
    return [b"".join(map(side.bytes_of.__getitem__, x.tolist())) == d for x, d in zip(ids, data)]


def _sizes(side) -> np.ndarray:
    if not hasattr(side, "sizes"):
        side.sizes = np.array([len(x) for x in side.bytes_of], dtype=np.int64)
    return side.sizes


def _names(side, last: str) -> np.ndarray:
    out = np.empty((len(side.bytes_of), 2), dtype=object)
    for i in range(len(out)):
        out[i] = b"%d," % i, b"%d%s" % (i, last.encode())
    return out


_loaded: dict[bytes, tuple] = {}


def _sides(data_a: bytes, data_b: bytes) -> tuple:
    """The worker's two tokenizers with the written forms of their ids."""
    key = hashlib.sha256(data_a).digest() + hashlib.sha256(data_b).digest()
    if key not in _loaded:
        _loaded.clear()
        a, b = ByteTokens(data_a), PieceTokens(data_b)
        _loaded[key] = a, b, _names(a, "|"), _names(b, ";")
    return _loaded[key]


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, keep: tuple[str, ...] = ("doc_id",), digest: bool = False
) -> DataFrame:
    """``keep`` columns and per document ``row_key`` (unique), ``n_a``,
    ``n_b``, ``n_groups``, ``n_links``, ``groups`` (the groups' ids as text;
    with ``digest`` its SHA-256 in hex), and its distinct linked id pairs:
    ``pairs`` (little-endian 64-bit numbers A id * vocabulary size of B + B id,
    ascending) with ``times`` (their links, 32-bit each)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((file_bytes(path_a), file_bytes(path_b)))
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + schema_of(
            "row_key long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"
        ).fields
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, names_a, names_b = _sides(*shared.value)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = Aligned(a, b, part.column("text").to_pylist())
                text, pair, times = found.pairs(len(b.bytes_of))
                cuts = np.searchsorted(text, np.arange(found.texts + 1)).tolist()
                pair, times = pair.astype("<u8").tobytes(), times.astype("<u4").tobytes()
                lists = list(found.listings(names_a, names_b))
                yield record_batch(
                    {
                        **{c: part.column(c) for c in keep},
                        "row_key": np.arange(row, row + found.texts),
                        "n_a": found.n_a,
                        "n_b": found.n_b,
                        "n_groups": found.n_groups,
                        "n_links": found.n_links,
                        "groups": [
                            hashlib.sha256(x).hexdigest() if digest and x else x.decode("ascii") for x in lists
                        ],
                        "pairs": [pair[8 * s : 8 * e] for s, e in zip(cuts, cuts[1:])],
                        "times": [times[4 * s : 4 * e] for s, e in zip(cuts, cuts[1:])],
                    },
                    arrow,
                )
                row += found.texts

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, size_b: int, held: int = 1 << 20) -> DataFrame:
    """(pair, n, best): in how many documents of ``aligned`` each id pair is
    linked, and whether no pair of the same A id is in more.  Tasks count in
    runs of at most some ``held`` distinct pairs before anything travels."""
    schema = schema_of("pair long, n long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        waiting: list[np.ndarray] = []
        size = 0

        def settle():
            each, n = np.unique(np.concatenate([np.empty(0, np.int64), *waiting]), return_counts=True)
            every, where = np.unique(np.r_[keys, each], return_inverse=True)
            return every, np.bincount(where, weights=np.r_[counts, n], minlength=len(every)).astype(np.int64)

        for batch in batches:
            for value in batch.column("pairs"):
                waiting.append(np.frombuffer(value.as_buffer(), dtype="<i8"))
                size += len(waiting[-1])
                if size >= 4 * held:
                    keys, counts = settle()
                    waiting, size = [], 0
                    if len(keys) >= held:
                        yield record_batch({"pair": keys, "n": counts}, arrow)
                        keys = counts = np.empty(0, dtype=np.int64)
        keys, counts = settle()
        yield record_batch({"pair": keys, "n": counts}, arrow)

    counted = aligned.select("pairs").mapInArrow(run, schema).groupBy("pair").agg(F.sum("n").alias("n"))
    counted = write_and_read(counted, "pair_counts")
    a = F.expr(f"pair div {size_b}")
    most = counted.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    # One row per A id: at most the vocabulary's size.
    joined = counted.withColumn("a", a).join(F.broadcast(most), "a")
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def cross_alignment(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    keep: tuple[str, ...] = ("doc_id",),
    digest: bool = False,
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """``keep`` columns and per document ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``groups``, ``n_best`` (links whose pair is a best one of its
    A id) and ``count_sum`` (the counts of all links, added up)."""
    spark = docs.sparkSession
    size_b = len(PieceTokens(file_bytes(path_b)).bytes_of)
    aligned = write_and_read(align_documents(docs, path_a, path_b, keep, digest), "alignments")
    counted = Scratch(spark).write(pair_counts(aligned, size_b), "pair_table")
    rows = counted.agg(F.sum("n")).first()[0] or 0
    least = -(-rows // most_pairs)
    often = counted.where(F.col("n") >= least).toArrow()
    pair = often.column("pair").to_numpy()
    order = np.argsort(pair)
    table = spark.sparkContext.broadcast(
        (pair[order], often.column("n").to_numpy()[order], often.column("best").to_numpy()[order])
    )

    def look_up(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(is broadcast, count, best) of each pair."""
        known, n, best = table.value
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        found = known[at] == keys if len(known) else np.zeros(len(keys), dtype=bool)
        n = np.where(found, n[at], 0) if len(known) else np.zeros(len(keys), dtype=np.int64)
        return found, n, found & best[at] if len(known) else found

    def unpack(cols: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.frombuffer(b"".join(cols["pairs"]), dtype="<i8")
        times = np.frombuffer(b"".join(cols["times"]), dtype="<u4").astype(np.int64)
        return keys, times, np.repeat(np.arange(len(cols["pairs"])), [len(x) // 8 for x in cols["pairs"]])

    plain = [*keep, "n_a", "n_b", "n_groups", "n_links", "groups"]
    sums = [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
    out = T.StructType([aligned.schema[c] for c in [*plain, "row_key"]] + sums)

    def add_up(cols: dict) -> dict:
        keys, times, row = unpack(cols)
        _, n, best = look_up(keys)
        total = np.zeros((2, len(cols["pairs"])), dtype=np.int64)
        np.add.at(total[0], row, times * best)
        np.add.at(total[1], row, times * n)
        return {**{c: cols[c] for c in [*plain, "row_key"]}, "n_best": total[0], "count_sum": total[1]}

    added = map_documents(aligned, add_up, out, [*plain, "row_key", "pairs", "times"], "pairs")
    if least <= 1:  # every pair is broadcast
        return added.drop("row_key")

    def others(cols: dict) -> dict:
        keys, times, row = unpack(cols)
        rest = np.flatnonzero(~look_up(keys)[0])
        return {"row_key": np.asarray(cols["row_key"])[row[rest]], "pair": keys[rest], "times": times[rest]}

    rare = map_documents(
        aligned, others, schema_of("row_key long, pair long, times long"), ["row_key", "pairs", "times"], "pairs"
    )
    rare = rare.join(counted.where(F.col("n") < least), "pair").groupBy("row_key").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("rare_best"),
        F.sum(F.col("times") * F.col("n")).alias("rare_sum"),
    )
    return added.join(rare, "row_key", "left").select(
        *plain,
        (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"),
    )
