"""Benchmark decontamination with a broadcast hash set of word windows.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased.  A window is n consecutive words of a benchmark item; an item of
fewer words (but not none) is one window of its own length.  The windows'
64-bit hashes are broadcast; tasks hash every word window of their documents,
look the hashes up and verify each hit word by word against the item's text.
Words inside a verified window are hit; maximal runs of hit words are spans,
which can be removed alone or with their documents.

The broadcast's size is checked first: the benchmark's normalised text is
dealt to parts of at most ``part_bytes`` each (hashes and text of a part take
some ten times that), and the documents are scanned once per part.  With more
than one part only documents with hits are kept of each scan, by the SHA-256
of their text, and joined once at the end; every window of every part counts.

Cases: null and empty texts have no words and no hits; items without words
occur nowhere; a word run shorter than the shortest window cannot be hit;
equal items are listed each by its id, an id that comes twice once; an item
without an id marks words but is neither counted nor listed; documents of any
length are scanned whole, in blocks cut between words.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import Scratch, map_documents, mix64, schema_of

#: Words of a window.
WINDOW = 10
#: Normalised benchmark text broadcast at once.
PART_BYTES = 8 << 20
#: Words of an item handled as one row (items are cut with an overlap).
ITEM_WORDS = 4096
#: Text hashed at once inside a slice.
BLOCK_BYTES = 1 << 20

#: Lower-cases A-Z and turns every other ASCII character that is no letter or
#: digit into a space.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

SPAN = "first int, words int, start long, bytes long"


class _Powers:
    """Powers of the hash base and of its inverse, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, BLOCK_BYTES + 4096)
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, base, dtype=np.uint64))])
                for base in (_BASE, _UNBASE)
            )


_powers = _Powers()


class Words:
    """The words of several texts: byte places in the normalised joined text,
    a 64-bit hash each, and the number of the text they stand in."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode("utf-8") for t in texts]
        self.data = b" ".join(raw).translate(_NORMAL)
        self.origin = np.cumsum([0, *(len(r) + 1 for r in raw)])
        codes = np.frombuffer(self.data, dtype=np.uint8)
        inside = np.zeros(len(codes) + 2, dtype=np.int8)
        inside[1:-1] = codes != 32
        turns = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        self.text = np.searchsorted(self.origin, self.starts, side="right") - 1
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))  # first word of each text
        self.hashes = self._hash(codes)

    def _hash(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(out):
            base = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, base + BLOCK_BYTES, side="right")))
            part = codes[base : self.ends[j - 1]].astype(np.uint64)
            part[part == 32] = 0
            _powers.reach(len(part))
            part *= _powers.up[: len(part)]
            at = self.starts[i:j] - base
            out[i:j] = mix64(np.add.reduceat(part, at) * _powers.down[at])
            i = j
        return out

    def windows(self, longest: int):
        """(length, hashes of all windows of that many words that lie in one
        text, by their first word; first words) for each length in turn."""
        held = np.zeros(len(self.hashes), dtype=np.uint64)
        for length in range(1, longest + 1):
            n = len(self.hashes) - length + 1
            if n <= 0:
                return
            held = held[:n] * _STEP + self.hashes[length - 1 :]
            firsts = np.flatnonzero(self.text[:n] == self.text[length - 1 :])
            yield length, held, firsts

    def bytes_of(self, first: int, length: int) -> bytes:
        """The window's words joined by one space."""
        return b" ".join(self.data[self.starts[first] : self.ends[first + length - 1]].split())


class WindowSet:
    """The distinct windows of a benchmark part: per window length the sorted
    hashes, the words themselves and the class of the items that hold them."""

    def __init__(self, rows: list[tuple[str | None, str]], n: int):
        words = Words([r[1] for r in rows])
        self.names = [r[0] for r in rows]
        counts = np.diff(words.first)
        self.longest = int(min(n, counts.max(initial=0)))
        self.by_length: dict[int, tuple] = {}
        self.classes: list[tuple[int, ...]] = []
        known: dict[tuple[int, ...], int] = {}
        for length, hashes, firsts in words.windows(self.longest):
            # Windows of n words, and the one window of a shorter item.
            firsts = firsts[np.minimum(n, counts[words.text[firsts]]) == length]
            if len(firsts) == 0:
                continue
            h, owner = mix64(hashes[firsts]), words.text[firsts]
            order = np.lexsort((owner, h))
            h, owner, firsts = h[order], owner[order], firsts[order]
            heads = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            keys, texts, kinds = [], [], []
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(h)]):
                held: dict[bytes, set[int]] = {}  # more than one text only if hashes collide
                for first, who in zip(firsts[a:b].tolist(), owner[a:b].tolist()):
                    held.setdefault(words.bytes_of(first, length), set()).add(who)
                for text, who in held.items():
                    group = tuple(sorted(who))
                    if group not in known:
                        known[group] = len(self.classes)
                        self.classes.append(group)
                    keys.append(h[a])
                    texts.append(text)
                    kinds.append(known[group])
            bits = min(24, max(16, (16 * len(keys)).bit_length()))
            sieve = np.zeros(1 << bits, dtype=bool)
            keys = np.array(keys, dtype=np.uint64)
            sieve[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.by_length[length] = (np.uint64(64 - bits), sieve, keys, texts, kinds)

    def scan(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[tuple]], list[list[str]]]:
        """Words, hit spans and ids of the occurring items of each text."""
        words = Words(texts)
        change = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        met: dict[int, set[int]] = {}
        for length, hashes, firsts in words.windows(self.longest):
            if length not in self.by_length:
                continue
            shift, sieve, keys, held, kinds = self.by_length[length]
            h = mix64(hashes)
            firsts = firsts[sieve[(h[firsts] >> shift).astype(np.int64)]]
            rows = np.searchsorted(keys, h[firsts])
            found = rows < len(keys)
            found[found] = keys[rows[found]] == h[firsts[found]]
            for first, row in zip(firsts[found].tolist(), rows[found].tolist()):
                text = words.bytes_of(first, length)
                while row < len(keys) and keys[row] == h[first]:
                    if held[row] == text:
                        change[first] += 1
                        change[first + length] -= 1
                        met.setdefault(int(words.text[first]), set()).add(kinds[row])
                        break
                    row += 1
        spans: list[list[tuple]] = [[] for _ in texts]
        items: list[list[str]] = [[] for _ in texts]
        if met:
            hit = np.zeros(len(change) + 1, dtype=np.int8)
            hit[1:] = np.cumsum(change) > 0
            for number, kind in met.items():
                a, b = int(words.first[number]), int(words.first[number + 1])
                turns = np.diff(np.r_[0, hit[a + 1 : b + 1], 0])
                for s, e in zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist()):
                    start, end = int(words.starts[a + s]), int(words.ends[a + e - 1])
                    spans[number].append((s, e - s, start - int(words.origin[number]), end - start))
                owners = set().union(*(self.classes[k] for k in kind))
                items[number] = sorted({self.names[o] for o in owners if self.names[o] is not None})
        return np.diff(words.first), spans, items


def benchmark_rows(benchmark: DataFrame, n: int = WINDOW, id_col: str = "item_id") -> DataFrame:
    """(item, words): normalised texts of the items, long ones cut into rows
    that overlap by n - 1 words, so that each window lies in one row."""

    def run(cols: dict) -> dict:
        out: dict[str, list] = {"item": [], "words": []}
        for item, text in zip(cols["item"], cols["text"]):
            found = (text or "").encode("utf-8").translate(_NORMAL).decode("utf-8").split(" ")
            found = [w for w in found if w]
            for at in range(0, max(len(found) - n, 0) + 1 if found else 0, ITEM_WORDS - n + 1):
                out["item"].append(item)
                out["words"].append(" ".join(found[at : at + ITEM_WORDS]))
        return out

    named = benchmark.select(F.col(id_col).cast("string").alias("item"), "text")
    return map_documents(named, run, schema_of("item string, words string"), ["item", "text"]).distinct()


def _merged(spans: list) -> list[tuple]:
    """Union of spans: overlapping and adjoining ones are one."""
    out: list[list[int]] = []
    for first, words, start, size in sorted(tuple(s) for s in spans):
        if out and first <= out[-1][0] + out[-1][1]:
            last = out[-1]
            last[1] = max(last[1], first + words - last[0])
            last[3] = max(last[3], start + size - last[2])
        else:
            out.append([first, words, start, size])
    return [tuple(s) for s in out]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    keep: tuple[str, ...] = ("doc_id",),
    id_col: str = "item_id",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``keep`` columns and per document ``n_words``, ``n_hit`` (words inside
    any occurring window), ``items`` (sorted ids of the items with occurring
    windows) and ``spans`` (maximal hit runs: first word, words, and place
    and size in the UTF-8 bytes of the text)."""
    spark = docs.sparkSession
    rows = Scratch(spark).write(benchmark_rows(benchmark, n, id_col), "benchmark_rows")
    total = rows.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    # Rows are dealt by hash; with a margin for uneven parts.
    parts = 1 if total <= part_bytes else -(-5 * total // (4 * part_bytes))
    in_part = F.pmod(F.xxhash64("words"), F.lit(parts))
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(schema_of(SPAN))),
    ]
    columns = list(dict.fromkeys([*keep, "text"]))

    def share(part: int):
        held = rows.where(in_part == part).select("item", "words").toArrow()
        return spark.sparkContext.broadcast(
            WindowSet(list(zip(held.column("item").to_pylist(), held.column("words").to_pylist())), n)
        )

    def scan(data, texts: list) -> dict:
        counts, spans, items = data.value.scan(texts)
        hit = [sum(s[1] for s in x) for x in spans]
        return {"n_words": counts, "n_hit": hit, "items": items, "spans": [[_named(s) for s in x] for x in spans]}

    if parts == 1:
        data = share(0)
        schema = T.StructType([docs.schema[c] for c in keep] + added)

        def run(cols: dict) -> dict:
            return {**{c: cols[c] for c in keep}, **scan(data, cols["text"])}

        return map_documents(docs, run, schema, columns)

    scratch, hits = Scratch(spark), None
    part_schema = T.StructType([T.StructField("text_key", T.BinaryType()), *added[2:]])
    for part in range(parts):
        data = share(part)

        def run_part(cols: dict, data=data) -> dict:
            found = scan(data, cols["text"])
            some = [i for i, x in enumerate(found["n_hit"]) if x]
            return {
                "text_key": [hashlib.sha256(cols["text"][i].encode("utf-8")).digest() for i in some],
                "items": [found["items"][i] for i in some],
                "spans": [found["spans"][i] for i in some],
            }

        held = scratch.write(
            map_documents(docs, run_part, part_schema, ["text"]).dropDuplicates(["text_key"]), "contamination_part"
        )
        data.destroy()
        hits = held if hits is None else hits.unionByName(held)
    whole = hits.groupBy("text_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
    )
    keyed_schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField("text_key", T.BinaryType()), added[0]]
    )

    def key(cols: dict) -> dict:
        keys = [hashlib.sha256((t or "").encode("utf-8")).digest() for t in cols["text"]]
        return {**{c: cols[c] for c in keep}, "text_key": keys, "n_words": np.diff(Words(cols["text"]).first)}

    joined = map_documents(docs, key, keyed_schema, columns).join(whole, "text_key", "left")
    final = T.StructType([docs.schema[c] for c in keep] + added)

    def settle(cols: dict) -> dict:
        spans = [_merged([(s["first"], s["words"], s["start"], s["bytes"]) for s in x or []]) for x in cols["spans"]]
        return {
            **{c: cols[c] for c in keep},
            "n_words": cols["n_words"],
            "n_hit": [sum(s[1] for s in x) for x in spans],
            "items": [x or [] for x in cols["items"]],
            "spans": [[_named(s) for s in x] for x in spans],
        }

    return map_documents(
        joined, settle, final, list(dict.fromkeys([*keep, "text_key", "n_words", "items", "spans"])), "text_key"
    )


def _named(span: tuple) -> dict:
    return dict(zip(("first", "words", "start", "bytes"), span))


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit word, with all their columns."""
    found = find_contamination(docs, benchmark, keep=tuple(docs.columns), **options)
    return found.where(F.col("n_hit") == 0).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All documents and columns; the texts without their hit spans (what
    stands between them stays as it is).  Other columns are left alone."""
    columns = docs.columns
    found = find_contamination(docs, benchmark, keep=tuple(columns), **options)

    def run(cols: dict) -> dict:
        texts = []
        for text, spans in zip(cols["text"], cols["spans"]):
            if spans:
                data, at, kept = text.encode("utf-8"), 0, []
                for s in spans:
                    kept.append(data[at : s["start"]])
                    at = s["start"] + s["bytes"]
                text = (b"".join(kept) + data[at:]).decode("utf-8")
            texts.append(text)
        return {**{c: cols[c] for c in columns}, "text": texts}

    return map_documents(found, run, docs.schema, [*columns, "spans"])
