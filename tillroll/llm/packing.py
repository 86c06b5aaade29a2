"""Best-fit packing of tokenized documents into sequences by sums of squares.

Each piece goes to the open sequence where the sum of the squared counts of
open sequences per residual gap becomes smallest (ties: the smallest gap);
a new sequence opens only when none has room.  Pieces come in decreasing
length.  Packing runs in independent groups of about ``group_sequences``
sequences, so each task holds a bounded number of piece lengths and no texts,
at the price of about one part-filled sequence a group.

Token ids are those of the tokenizers library.  Its pre-tokenizer drops white
space and never joins across it, so ids are kept per white-space-separated
chunk and per word in it, in bounded generations per worker.

Cases: a null or empty text is one piece with the end id only; a document
longer than a sequence is cut into full sequences and a rest; repeated
documents are packed once per row (their pieces are equal rows but for the
place).
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.bpe import SPACE, byte_alphabet
from tillroll.llm.common import Kept, file_bytes, map_documents, schema_of
from tillroll.plans.materialize import write_and_read

#: Chunks whose ids a worker keeps (twice as many at most, some 200 bytes
#: each); longer ones are not kept.
CACHE, LONG = 700_000, 64
#: Fixed value: the pre-tokenizer's pattern.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
_WORDS = regex.compile(PATTERN)
#: Up to this character (the end of the Latin letters) normalisation and lower
#: case need no tables of the library's own.
_LATIN = "\u024f"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class ChunkTokenizer:
    """Ids of whole texts, chunk by chunk (a chunk has no ASCII white space).

    A word's merges run in tiktoken: the vocabulary's word end becomes a NUL
    after the word, which joins its last character before anything else
    merges.  Chunks with letters beyond Latin ones, with a NUL or with a
    special token's beginning go through the library."""

    def __init__(self, data: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(data.decode("utf-8"))
        self.library.no_padding()
        self.library.no_truncation()
        spec = json.loads(data)
        suffix = spec["model"]["end_of_word_suffix"]
        byte_of = {c: b for b, c in byte_alphabet().items()}
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            ends = token.endswith(suffix)
            stem = token[: -len(suffix)] if ends else token
            if all(c in byte_of for c in stem):
                ranks[bytes(byte_of[c] for c in stem) + (b"\0" if ends else b"")] = i
        self.merge = tiktoken.Encoding(
            "words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.chunks = Kept(self._chunk, CACHE, LONG)

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8")
        if max(text) > _LATIN or "<|" in text or "\0" in text:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        text = (text if text.isascii() else unicodedata.normalize("NFC", text)).lower()
        ids = self.merge("\0".join([*_WORDS.findall(text), ""]))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for text in texts:
            yield b"".join(map(self.chunks.__getitem__, text.encode("utf-8").split())) if text else b""


_loaded: dict[bytes, ChunkTokenizer] = {}


def _tokenizer(data) -> ChunkTokenizer:
    key = hashlib.sha256(data.value).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ChunkTokenizer(data.value)
    return _loaded[key]


def token_pieces(docs: DataFrame, vocabulary_path: str, size: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32)."""
    data = docs.sparkSession.sparkContext.broadcast(file_bytes(vocabulary_path))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(cols: dict) -> dict:
        rows = []
        for doc_id, ids in zip(cols["doc_id"], _tokenizer(data).encode(cols["text"])):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * size)):
                part = ids[at : at + 4 * size]
                rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
        return dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), zip(*rows)))

    return map_documents(docs, run, schema_of(PIECES), ["doc_id", "text"])


def place_by_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, in the order given."""
    open_at: list[list[int]] = [[] for _ in range(size + 1)]  # sequences by gap
    count = np.zeros(size + 1, dtype=np.int64)
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    opened = 0
    for i, s in enumerate(lengths.tolist()):
        held = count[s:]
        gaps = np.flatnonzero(held)
        if len(gaps) == 0:
            number, gap = opened, size
            opened += 1
        else:
            # Moving a sequence from gap h to h - s changes the sum of squares
            # by 2 (N[h - s] - N[h] + 1); one that fills up only leaves, which
            # changes it by 1 - 2 N[h].
            change = 2 * (count[gaps] - held[gaps] + 1)
            if gaps[0] == 0:
                change[0] = 1 - 2 * held[0]
            gap = int(gaps[np.argmin(change)]) + s
            number = open_at[gap].pop()
            count[gap] -= 1
        sequence[i], offset[i] = number, size - gap
        rest = gap - s
        if rest:
            open_at[rest].append(number)
            count[rest] += 1
    return sequence, offset


def pack(pieces: DataFrame, size: int = 4096, group_sequences: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the pieces.  ``pieces`` is a
    written table that is read twice (its total length sets the number of
    groups).  A piece's place in it takes part in the choice of its group, so
    equal pieces spread over all groups."""
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (size * group_sequences)))
    spread = pieces.withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)).cast("long")
    )

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        sequence, offset = place_by_squares(frame["length"].to_numpy(), size)
        frame = frame.assign(sequence_id=frame["group"] * (1 << 32) + sequence, offset=offset)
        return frame.drop(columns="group")

    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return spread.groupBy("group").applyInPandas(place, schema)


def pack_documents(docs: DataFrame, vocabulary_path: str, size: int = 4096, end_id: int = 1) -> DataFrame:
    """Tokenize and pack ``docs``.  The piece table (some 40 bytes a piece) is
    written once to the checkpoint folder."""
    return pack(write_and_read(token_pieces(docs, vocabulary_path, size, end_id), "token_pieces"), size)
