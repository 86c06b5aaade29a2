"""Runs of words against a plain search over all periods."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
from cases import documents, texts, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import queries
from tillroll.llm import runs as R


def brute(w, least=6, exponent=4):
    """(start, length, smallest period) of every run, by start, then period."""
    out = set()
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            size = j - i + p
            if j > i and size >= max(least, exponent * p):
                part = w[i : i + size]
                if not any(part[q:] == part[:-q] for q in range(1, p)):
                    out.add((i, size, p))
            i = max(i, j) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def best_and_kept(w, found):
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    lost = {i for s, n, q in found for i in range(s + q, s + n)}
    return best, " ".join(x for i, x in enumerate(w) if i not in lost)


def planted(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


PERIODIC = st.builds(
    lambda head, unit, times, tail: head + unit * times + tail,
    st.lists(st.integers(0, 2), max_size=8),
    st.lists(st.integers(0, 2), min_size=1, max_size=9),
    st.integers(1, 9),
    st.lists(st.integers(0, 2), max_size=8),
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PERIODIC, max_size=5), st.integers(2, 5))
def test_runs_equal_plain_search(docs, exponent):
    got = R.find_runs([np.array(d, dtype=np.int64) for d in docs], exponent=exponent)
    for d, rows in zip(docs, got):
        assert [tuple(r) for r in rows.tolist()] == brute(d, exponent=exponent)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=120), st.data())
def test_extensions(seq, data):
    body = len(seq)
    e = R.CommonExtensions(np.array(seq + list(range(3, 3 + R.V))))
    pairs = data.draw(st.lists(st.tuples(st.integers(0, body - 1), st.integers(0, body - 1)), min_size=1, max_size=30))
    pairs = [(i, j) for i, j in pairs if i != j] or [(0, 1)]
    got = e.lce(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    for (i, j), n in zip(pairs, got.tolist()):
        k = 0
        while max(i, j) + k < body and seq[i + k] == seq[j + k]:
            k += 1
        assert n == k


def test_batches_and_long_texts(monkeypatch):
    monkeypatch.setattr(R, "BATCH", 50)
    long = [0] * 3000 + list(range(1, 40)) * 60 + [5, 6] * 200
    got = R.find_runs([np.array(long), np.array([], dtype=np.int64), np.array([7] * 6)])
    assert [tuple(r) for r in got[0].tolist()] == brute(long)
    assert got[1].tolist() == [] and got[2].tolist() == [[0, 6, 1]]


def test_documents(spark):
    rows = [*texts(), (30, "a b a b a b a b c c c c c c", "en", "s", 1), (30, "a b a b a b a b c c c c c c", "en", "s", 1),
            (None, "z " * 9, "en", "s", 1)]
    got = R.periodic_runs(documents(spark, rows, clash=True), keep=("doc_id", "start")).collect()
    assert len(got) == len(rows) and all(r.start == 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    for i, t, *_ in rows:
        w = words(t)
        found = brute(w)
        best, kept = best_and_kept(w, found)
        r = by_id[i]
        assert [tuple(x) for x in r.runs] == found and r.n_words == len(w)
        assert (tuple(r.best) if r.best else None) == best and r.collapsed == kept
    assert R.periodic_runs(documents(spark, [])).count() == 0


def test_query_equals_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, sf).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        w = planted(d.doc_id, d.text)
        if len(w) > 2500:
            continue  # the plain search takes too long here
        found = brute(w)
        best, kept = best_and_kept(w, found)
        r = got[d.doc_id]
        assert r.n_runs == len(found) and r.collapsed_sha256 == sha(kept)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert ((r.start, r.length, r.period) if found else None) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
