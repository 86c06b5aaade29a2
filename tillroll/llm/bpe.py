"""Byte-level BPE encoding and decoding.

The merges of a word run over a segment tree whose leaves are the adjacent
pairs, valued by (merge rank, place).  The root is the leftmost pair of the
lowest rank; a merge changes three leaves, each with a logarithmic update,
until the root says that no pair can merge.

Whole texts are cut at places no token crosses (before white space that
follows other characters); the chunks' ids are kept per worker, so the tree
runs once per distinct chunk.  Ids travel as a binary column of little-endian
unsigned 32-bit integers (``numpy.frombuffer(ids, '<u4')``).

Cases: null and empty texts give no ids and decode to the empty text; the
special token's string inside a text becomes its id, as the tokenizers
library does by default; ids that do not form valid UTF-8 decode with
replacement characters.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.common import Kept, file_bytes, map_documents

#: Chunks whose ids a worker keeps (twice as many at most, some 200 bytes each).
CACHE = 700_000
#: Longer chunks and words are not kept.
LONG = 64
#: Unicode white space, as the pre-tokenizer's pattern sees it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Fixed value: the pre-tokenizer's pattern.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

_WORDS = regex.compile(PATTERN)
_CHUNKS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: White space before a space; the ASCII ones first.
SPACE_RUNS = [c + " " for c in " \t\n\x0b\x0c\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"]
SPACE_RUNS += [chr(c) + " " for c in range(0x2000, 0x200B)]


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: Leaf of the segment tree without a mergeable pair.
NONE = 1 << 62


def merge_pairs(symbols: list[int], merges: dict[int, tuple[int, int]]) -> list[int]:
    """Merge the leftmost pair of the lowest rank until no pair can merge.

    ``merges`` maps left << 32 | right to (rank, merged symbol).  The tree's
    leaf i holds rank * n + i of the pair that starts at symbol i, inner nodes
    the smaller child, so the root tells rank and place of the next merge.
    ``symbols`` is used up."""
    n = len(symbols)
    get = merges.get
    leaves = 1 << (n - 2).bit_length()
    tree = [NONE] * (2 * leaves)
    some = False
    for i in range(n - 1):
        found = get(symbols[i] << 32 | symbols[i + 1])
        if found is not None:
            tree[leaves + i] = found[0] * n + i
            some = True
    if not some:
        return symbols
    for i in range(leaves - 1, 0, -1):
        low, high = tree[2 * i], tree[2 * i + 1]
        tree[i] = low if low < high else high
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (root := tree[1]) != NONE:
        left = root % n
        right = after[left]
        merged = get(symbols[left] << 32 | symbols[right])[1]
        symbols[left], symbols[right] = merged, -1
        follow = after[left] = after[right]
        changes = []
        if right < n - 1:
            changes.append((right, NONE))
        value = NONE
        if follow < n:
            before[follow] = left
            found = get(merged << 32 | symbols[follow])
            if found is not None:
                value = found[0] * n + left
        changes.append((left, value))
        back = before[left]
        if back >= 0:
            found = get(symbols[back] << 32 | merged)
            changes.append((back, NONE if found is None else found[0] * n + back))
        for place, value in changes:  # logarithmic point updates
            i = leaves + place
            if tree[i] == value:
                continue
            tree[i] = value
            while i > 1:
                other = tree[i ^ 1]
                i >>= 1
                low = value if value < other else other
                if tree[i] == low:
                    break
                tree[i] = value = low
    return [x for x in symbols if x >= 0]


class ByteBPE:
    """Encoder and decoder of one vocabulary file (tokenizers' JSON)."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        vocab = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        byte_of = {c: b for b, c in alphabet.items()}
        self.byte_ids = [vocab[alphabet[b]] for b in range(256)]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in t)
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode("utf-8")
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words = Kept(self.encode_word, CACHE // 4, LONG)
        self.plain = Kept(self.encode_chunk, CACHE // 8, LONG)
        self.spaced = Kept(lambda chunk: self.encode_chunk(" " + chunk), CACHE, LONG)

    def encode_word(self, word: str) -> bytes:
        """Ids of one pre-token, by the segment tree."""
        symbols = [self.byte_ids[b] for b in word.encode("utf-8")]
        if len(symbols) > 1:
            symbols = merge_pairs(symbols, self.merges)
        return struct.pack(f"<{len(symbols)}I", *symbols)

    def encode_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.words.__getitem__, _WORDS.findall(chunk)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, little-endian unsigned 32-bit."""
        if not text:
            return b""
        if self.split is not None and any(s in text for s in self.special):
            parts = self.split.split(text)
            return b"".join(
                np.array([self.special[p]], dtype="<u4").tobytes() if p in self.special else self._encode_plain(p)
                for p in parts
            )
        return self._encode_plain(text)

    def _encode_plain(self, text: str) -> bytes:
        if not text:
            return b""
        runs = SPACE_RUNS[:6] if text.isascii() else SPACE_RUNS
        if text[0] == " " or text[-1] == " " or any(run in text for run in runs):
            return b"".join(map(self.plain.__getitem__, _CHUNKS.findall(text)))
        # White space stands alone: each word begins a chunk with its space.
        first, *rest = text.split(" ")
        return self.plain[first] + b"".join(map(self.spaced.__getitem__, rest))

    def decode(self, ids: bytes | None) -> str:
        numbers = np.frombuffer(ids or b"", dtype="<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, numbers)).decode("utf-8", "replace")


_loaded: dict[int, ByteBPE] = {}


def _bpe(data) -> ByteBPE:
    """The worker's encoder of a broadcast vocabulary file."""
    key = hash(data.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ByteBPE(data.value)
    return _loaded[key]


def encode(docs: DataFrame, vocabulary_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids`` (binary) of every whole text."""
    data = docs.sparkSession.sparkContext.broadcast(file_bytes(vocabulary_path))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("ids", T.BinaryType())])

    def run(cols: dict) -> dict:
        bpe = _bpe(data)
        return {**{c: cols[c] for c in keep}, "ids": [bpe.encode(x) for x in cols["text"]]}

    return map_documents(docs, run, schema, list(dict.fromkeys([*keep, "text"])))


def decode(encoded: DataFrame, vocabulary_path: str, keep: tuple[str, ...] = ("doc_id", "ids")) -> DataFrame:
    """``keep`` columns and ``decoded`` (text) of every row's ``ids``."""
    data = encoded.sparkSession.sparkContext.broadcast(file_bytes(vocabulary_path))
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField("decoded", T.StringType())])

    def run(cols: dict) -> dict:
        bpe = _bpe(data)
        return {**{c: cols[c] for c in keep}, "decoded": [bpe.decode(x) for x in cols["ids"]]}

    return map_documents(encoded, run, schema, list(dict.fromkeys([*keep, "ids"])), text_col="ids")


def round_trip(docs: DataFrame, vocabulary_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` and what they decode to, in one task per
    partition (one Python worker instead of two)."""
    data = docs.sparkSession.sparkContext.broadcast(file_bytes(vocabulary_path))
    added = [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    schema = T.StructType([docs.schema[c] for c in keep] + added)

    def run(cols: dict) -> dict:
        bpe = _bpe(data)
        ids = [bpe.encode(x) for x in cols["text"]]
        return {**{c: cols[c] for c in keep}, "ids": ids, "decoded": [bpe.decode(x) for x in ids]}

    return map_documents(docs, run, schema, list(dict.fromkeys([*keep, "text"])))
