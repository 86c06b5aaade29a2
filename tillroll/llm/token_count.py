"""Token counts by finite-state tokenizer compilation.

The sentencepiece BPE of a text is the only segmentation in which every two
neighbouring tokens stay apart when they are merged alone.  Reading left to
right, the last token of each prefix is therefore determined by the last
tokens of a few earlier prefixes: a deterministic transducer.  A state holds
the longest suffix that a vocabulary piece can still grow from, with the last
token at each place inside it; a transition carries the change of the token
count.  States and transitions are compiled on first use and kept.

A text is cut into chunks.  Each chunk has a state map (entry state -> exit
state and emitted count); maps compose, and an inclusive prefix scan over
them (log2 rounds) gives the state and count after every chunk.  No piece
continues over a word mark after a letter, so a chunk that starts with a word
mark has a constant map, which is cached by its text; only words longer than
``BLOCK`` need blocks whose entry state is not known beforehand.

Cases: null and empty texts have 0 tokens; symbols outside the vocabulary
count one token per UTF-8 byte; strings like ``<s>`` in a text are ordinary
characters.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import Kept, map_documents

MARK = "▁"  # stands for a space inside the model
#: Longest stretch of a word that is one chunk.
BLOCK = 256
#: Words whose counts (twice as many at most), and states that, a worker keeps.
CACHE = 450_000
MOST_STATES = 350_000

State = tuple  # (open suffix, ((last token or None, relative count) or None, ...))
START: State = ("", ((None, 0),))


@dataclass
class Vocabulary:
    """Pieces with their scores; ``prefix`` tells whether a text gets a
    leading space."""

    scores: dict[str, float]
    prefix: bool
    digest: str = ""  # of the model file

    @staticmethod
    def load(path: str) -> "Vocabulary":
        import sentencepiece

        with open(path, "rb") as f:
            digest = hashlib.sha256(f.read()).hexdigest()
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        scores = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not special(i)}
        if any(MARK in p.lstrip(MARK) for p in scores) or len(sp.encode("a   b", out_type=str)) == len(
            sp.encode("a b", out_type=str)
        ):
            raise ValueError("the compiler takes models that keep white space and never merge across a word mark")
        return Vocabulary(scores, sp.encode("a", out_type=str)[0].startswith(MARK), digest)


class Transducer:
    """Lazily compiled transducer of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.scores = vocabulary.scores
        self.prefix = vocabulary.prefix
        self.pieces = {p for p in self.scores if len(p) > 1 and self.merge(p) == [p]}
        self.grows = {p[:i] for p in self.pieces for i in range(1, len(p) + 1)}
        self._clear()
        self.apart: dict[tuple[str, str], bool] = {}
        self.counts = Kept(lambda word: self.count_chunk(MARK + word), CACHE, BLOCK)

    def _clear(self) -> None:
        self.states: list[State] = [START]
        self.numbers: dict[State, int] = {START: 0}
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]

    def merge(self, word: str) -> list[str]:
        """Plain BPE of a short string, used only to compile arcs."""
        parts = list(word)
        while len(parts) > 1:
            ranked = [
                (-self.scores[parts[i] + parts[i + 1]], i)
                for i in range(len(parts) - 1)
                if parts[i] + parts[i + 1] in self.scores
            ]
            if not ranked:
                break
            _, i = min(ranked)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _stay_apart(self, left: str | None, right: str) -> bool:
        if left is None:
            return True
        key = (left, right)
        if key not in self.apart:
            if len(self.apart) > CACHE:
                self.apart.clear()
            self.apart[key] = self.merge(left + right) == [left, right]
        return self.apart[key]

    def _cost(self, token: str) -> int:
        return 1 if token in self.scores else len(token.encode("utf-8"))

    def _compile(self, number: int, symbol: str) -> tuple[int, int]:
        suffix, places = self.states[number]
        if symbol == MARK and not suffix.endswith(MARK):
            suffix, places = START  # nothing merges over this boundary
        for k, place in enumerate(places):
            if place is None:
                continue
            token = suffix[k:] + symbol
            if (len(token) == 1 or token in self.pieces) and self._stay_apart(place[0], token):
                last, count = token, place[1] + self._cost(token)
                break
        else:  # cannot happen for a consistent vocabulary
            raise ValueError(f"no segmentation of {suffix + symbol!r}")
        grown = suffix + symbol
        cut = next((k for k in range(len(grown)) if grown[k:] in self.grows), len(grown))
        rest = grown[cut:]
        if not rest:
            state: State = START
        else:
            kept = [
                (p[0], p[1] - count) if p is not None and rest[k:] in self.grows else None
                for k, p in enumerate(places[cut:])
            ]
            state = (rest, (*kept, (last, 0)))
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.arcs.append({})
        arc = (self.numbers[state], count)
        self.arcs[number][symbol] = arc
        return arc

    def run(self, symbols: str, entry: int = 0) -> tuple[int, int]:
        """Exit state and emitted count for ``symbols`` from state ``entry``."""
        state, total, arcs = entry, 0, self.arcs
        for s in symbols:
            arc = arcs[state].get(s)
            if arc is None:
                arc = self._compile(state, s)
            state = arc[0]
            total += arc[1]
        return state, total

    def count(self, text: str | None) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        if self.prefix and MARK not in text:
            words = text.split(" ")
            if all(words):
                return sum(map(self.counts.__getitem__, words))
        marked = (MARK if self.prefix else "") + text.replace(" ", MARK)
        return sum(self.count_chunk(c) for c in _CHUNKS.findall(marked))

    def count_chunk(self, chunk: str) -> int:
        """Tokens of a chunk that starts at a boundary."""
        if len(self.states) > MOST_STATES:
            self._clear()
        if len(chunk) <= BLOCK:
            return self.run(chunk)[1]
        blocks = [chunk[i : i + BLOCK] for i in range(0, len(chunk), BLOCK)]
        maps = [StateMap(self, [blocks[0]], fixed=self.run(blocks[0]))]
        for before, block in zip(blocks, blocks[1:]):
            guess, _ = self.run(before[-32:])
            maps.append(StateMap(self, [block], arcs={guess: self.run(block, guess)}))
        return prefix_scan(maps)[-1].fixed[1]


_CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass
class StateMap:
    """State map of consecutive blocks: constant (``fixed``) or by entry
    state.  An entry state that was not foreseen is run when it comes up."""

    transducer: Transducer
    blocks: list[str]
    fixed: tuple[int, int] | None = None
    arcs: dict[int, tuple[int, int]] = field(default_factory=dict)

    def at(self, entry: int) -> tuple[int, int]:
        if self.fixed is not None:
            return self.fixed
        if entry not in self.arcs:
            state, total = entry, 0
            for b in self.blocks:
                state, emitted = self.transducer.run(b, state)
                total += emitted
            self.arcs[entry] = (state, total)
        return self.arcs[entry]

    def then(self, other: "StateMap") -> "StateMap":
        """This map followed by ``other``."""

        def on(arc: tuple[int, int]) -> tuple[int, int]:
            state, emitted = other.at(arc[0])
            return state, arc[1] + emitted

        blocks = self.blocks + other.blocks
        if self.fixed is not None:
            return StateMap(self.transducer, blocks, fixed=on(self.fixed))
        return StateMap(self.transducer, blocks, arcs={e: on(a) for e, a in self.arcs.items()})


def prefix_scan(maps: list[StateMap]) -> list[StateMap]:
    """Inclusive scan by doubling: after round r each map covers 2^r chunks."""
    step = 1
    while step < len(maps):
        maps = [m if i < step else maps[i - step].then(m) for i, m in enumerate(maps)]
        step *= 2
    return maps


_compiled: dict[str, Transducer] = {}


def _transducer(vocabulary) -> Transducer:
    """The worker's transducer of a broadcast vocabulary."""
    key = vocabulary.value.digest
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(vocabulary.value)
    return _compiled[key]


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every
    document.  The vocabulary (32k pieces) is read once and broadcast."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )

    def run(cols: dict) -> dict:
        t = _transducer(vocabulary)
        texts = cols["text"]
        return {
            **{c: cols[c] for c in keep},
            "n_bytes": [len(x.encode("utf-8")) if x else 0 for x in texts],
            "n_tokens": [t.count(x) for x in texts],
        }

    counted = map_documents(docs, run, schema, list(dict.fromkeys([*keep, "text"])))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
