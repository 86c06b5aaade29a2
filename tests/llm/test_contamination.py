"""Benchmark decontamination against a plain search of all word windows."""

import re

import pytest
from cases import documents, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import contamination as C
from tillroll.llm import queries

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def words(text):
    lowered = (text or "").translate(str.maketrans(LETTERS.upper(), LETTERS))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items, n):
    """(words, hit words, sorted ids) of one text."""
    held, hit, met = words(text), set(), set()
    for item, passage in items:
        w = words(passage)
        size = min(n, len(w))
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
        for i in range(len(held) - size + 1):
            if tuple(held[i : i + size]) in windows:
                hit.update(range(i, i + size))
                met.add(item)
    return len(held), len(hit), sorted(str(m) for m in met if m is not None)


def items():
    base = texts()[0][1]
    return [
        (1, base[40:150]),
        (10, "  SEVEN old, owls... watch from the tall pine and nobody"),
        (2, "dog NEAR"),  # fewer words than a window
        (3, None),
        (4, "... --- !!!"),
        (5, base[40:150]),
        (5, base[40:150]),
        (None, "quick brown"),
        (6, "über straße naïve café über"),
        (7, "nothing of this is there at all, not in one of them, never"),
        (8, "2 3"),
        (9, " ".join(f"w{i} zebra{i % 7}" for i in range(100, 4000))),
    ]


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("part_bytes", [C.PART_BYTES, 25_000])
def test_documents_equal_plain_search(spark, part_bytes):
    rows = [*texts(), (50, "The quick, dog near", "en", "s", 1), (51, texts()[10][1], "en", "s", 1)]
    docs = documents(spark, rows, clash=True)
    got = C.find_contamination(docs, bench(spark, items()), keep=("doc_id", "start"), part_bytes=part_bytes).collect()
    want = {r[0]: brute(r[1], items(), 10) for r in rows}
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want
    assert len(got) == len(rows) and all(r.start == 1 for r in got)
    assert sum(r.n_hit > 0 for r in got) > 5


def test_empty_tables_and_repeats(spark):
    none = bench(spark, [])
    assert {r.n_hit for r in C.find_contamination(documents(spark), none).collect()} == {0}
    assert C.find_contamination(documents(spark, []), bench(spark, items())).count() == 0
    twice = [texts()[0], texts()[0], (None, texts()[0][1], "en", "s", 1)]
    got = C.find_contamination(documents(spark, twice), bench(spark, items()), part_bytes=25_000).collect()
    assert len(got) == 3 and len({(r.n_words, r.n_hit, tuple(r["items"])) for r in got}) == 1


def test_removal(spark):
    rows = [
        (0, "Before it: the quick brown fox jumps over the lazy dog near the river! After.", "en", "s", 1),
        (1, "clean text", "en", "s", 1),
        (2, None, "en", "s", 1),
        (3, "é ü THE QUICK-BROWN fox jumps over the lazy dog near", "en", "s", 1),
    ]
    docs = documents(spark, rows, clash=True)
    passage = bench(spark, [(1, "the quick brown fox jumps over the lazy dog near")])
    cut = C.remove_spans(docs, passage)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {
        0: "Before it:  the river! After.", 1: "clean text", 2: None, 3: "é ü "
    }
    kept = C.remove_documents(docs, passage)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]


WORDS = st.lists(st.sampled_from(["a", "B", "c", "é", "1", "-", "a-b", "  "]), max_size=25).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(WORDS, max_size=4), st.lists(WORDS, max_size=4), st.integers(1, 4))
def test_scan_equals_plain_search(docs, passages, n):
    rows = [(str(i), " ".join(words(p))) for i, p in enumerate(passages)]
    counts, spans, found = C.WindowSet([r for r in rows if r[1]], n).scan(docs)
    for k, text in enumerate(docs):
        want = brute(text, list(enumerate(passages)), n)
        assert (int(counts[k]), sum(s[1] for s in spans[k]), found[k]) == want
        data = text.encode()
        for first, size, start, length in spans[k]:
            assert words(data[start : start + length].decode()) == words(text)[first : first + size]


def test_blocks_and_long_words(monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BYTES", 64)
    text = "x" * 500 + " one two three four " + "y" * 90 + " five " * 30
    got = C.WindowSet([("1", "three four " + "y" * 90 + " five")], 4).scan([None, text, "", text])
    assert [sum(s[1] for s in x) for x in got[1]] == [0, 4, 0, 4]


def test_query_equals_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in queries.op12_benchmark_decontamination(spark, sf).collect()}
    passages = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n, hit, met = brute(r.text, passages, 10)
        want[r.doc_id] = (n, hit, len(met))
    assert got == want
