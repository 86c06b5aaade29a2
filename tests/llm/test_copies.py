"""N-gram join, repeat removal and fingerprints against brute force."""

import random

import numpy as np
import pytest
from cases import BASE, components, documents, repeats, texts
from pyspark.sql import functions as F

from tillroll.llm import ngram_join
from tillroll.llm import repeats as rep
from tillroll.llm import sketch
from tillroll.llm.components import connected_components


def near_copies(n=60, seed=5):
    """Groups with small edits, chains, and unrelated texts."""
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(400)]
    rows = []
    for g in range(4):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((12, 40, 90, 200)))]
        for _ in range(n // 6):
            copy = list(base)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
            base = copy if g % 2 else base
    rows += [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))) for _ in range(n // 3)]
    rng.shuffle(rows)
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(rows)]


@pytest.mark.parametrize("words,percent,block", [(3, 90, 1 << 16), (5, 80, 1 << 16), (2, 70, 150)])
def test_join_equals_all_pairs(spark, words, percent, block):
    rows = near_copies() + [(1000 + r[0] % 1000, *r[1:]) for r in texts()[:-1]]
    got = ngram_join.jaccard_components(documents(spark, rows, clash=True), words, percent, block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(rows, words, percent)


def test_large_component_is_split_and_still_exact(spark):
    """A chain whose ends are unlike, in blocks of a few sets each."""
    w = [f"c{i}" for i in range(130)]
    rows = [(i, " ".join(w[2 * i : 2 * i + 60]), "en", "s", 0) for i in range(30)]
    got = ngram_join.jaccard_components(documents(spark, rows), 1, 90, 200).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(rows, 1, 90)


def test_unlike_sets_of_one_component_are_dropped_by_their_sketches(spark):
    """Unlike documents with one common passage are one candidate component;
    its pairs go by key, size and sketch, so few sets are left to intersect."""
    rng = random.Random(11)
    passage = " ".join(f"p{k}" for k in range(50))
    rows = []
    for i in range(90):
        own = [f"u{i}x{rng.randrange(10**9)}" for _ in range(300 if i % 2 else 1500)]
        rows.append((i, " ".join([*own[:100], passage, *own[100:]]), "en", "s", 0))
    rows += [(1000 + i, rows[i][1] + " one more", "en", "s", 0) for i in (3, 4)]
    sets = [(0, 2, i, ngram_join.shingle_hashes(t, 5).tobytes()) for i, t, *_ in rows]
    members = spark.createDataFrame(sets, "component long, pieces long, doc_id long, tokens binary")
    labels = members.selectExpr("doc_id", "doc_id as label")
    for key_rows, slots in ((4096, 64), (7, 64), (7, 1)):
        pairs = ngram_join.OpenSets(members, 80, key_rows, slots).pairs(labels, 100).collect()
        assert {(r.a, r.b) for r in pairs} == {(3, 1003), (4, 1004)}
    none = spark.createDataFrame([], "a long, b long")
    assert {(r.a, r.b) for r in ngram_join._last_round(members, none, 80, 2000).collect()} == {(3, 1003), (4, 1004)}
    got = ngram_join.jaccard_components(documents(spark, rows), 5, 80, 2000).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(rows, 5, 80)


def test_dense_groups_pass_on_few_pairs(spark):
    """Near copies in several classes: a pair of classes passes on its closest
    pairs only, and the result still equals all pairs."""
    rng = random.Random(3)
    rows = []
    for g in range(2):
        base = [f"g{g}w{k}" for k in range(150)]
        for _ in range(70):
            copy = list(base)
            for _ in range(rng.randrange(1, 6)):
                copy[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy), "en", "s", 0))
    want = components(rows, 5, 80)
    sets = [(i, ngram_join.shingle_hashes(t, 5).tobytes()) for i, t, *_ in rows]
    members = spark.createDataFrame(sets, "doc_id long, tokens binary")
    labels = spark.createDataFrame([(i, 70 * (i // 70) + i % 5) for i in range(140)], "doc_id long, label long")
    counts = {}
    for limit in (0, 1, 16, 10_000):
        pairs = ngram_join.OpenSets(members, 80, key_rows=20).pairs(labels, limit).collect()
        names = {(r.label_a, r.label_b) for r in pairs}
        counts[limit] = len({(r.a, r.b) for r in pairs})
        assert all(a // 70 == b // 70 and a < b for a, b in names)
        if limit < 2:
            assert counts[limit] == len(names) <= 20
    assert counts[1] <= counts[16] <= counts[10_000] and counts[10_000] > 500
    got = ngram_join.jaccard_components(documents(spark, rows), 5, 80, 300).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_keys_of_linked_sets_meet():
    rng = np.random.default_rng(1)
    for percent in (70, 80, 90):
        bands = ngram_join.Bands(percent)
        for _ in range(200):
            n = int(rng.integers(1, 300))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            b = np.unique(np.r_[a[: len(a) - int(rng.integers(0, n // 4 + 1))], rng.integers(0, 2**63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)])
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= percent * (len(a) + len(b) - both) and len(a) + len(b) > 2 * both:
                assert len(np.intersect1d(ngram_join.part_keys(a, bands), ngram_join.part_keys(b, bands)))


def test_sketch_distance_bounds_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(100):
        a = np.unique(rng.integers(0, 500, 200).astype(np.uint64))
        b = np.unique(rng.integers(0, 500, 200).astype(np.uint64))
        apart = int(np.bitwise_count(ngram_join.parity_sketch(a) ^ ngram_join.parity_sketch(b)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_join_of_nothing(spark):
    assert ngram_join.jaccard_components(documents(spark, [])).count() == 0
    rows = [(None, BASE, "en", "s", 1), (None, None, None, None, None), (3, BASE, "en", "s", 1)]
    got = ngram_join.jaccard_components(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(3, 3)]


def test_one_row_of_each_group_stays(spark):
    rows = texts() + [texts()[0], (0, "another text under the same id", "en", "s", 1)]
    kept = ngram_join.keep_representatives(documents(spark, rows)).collect()
    ids = [r.doc_id for r in kept]
    assert len(ids) == len(set(ids))
    want = {i for i, (_, c) in components(texts(), 5, 80).items() if i == c}
    assert set(ids) == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


@pytest.mark.parametrize("small", [False, True])
def test_repeats_equal_brute_force(spark, monkeypatch, small):
    if small:  # many blocks and buckets, and hot anchors
        monkeypatch.setattr(rep, "BLOCK_BYTES", 500)
        monkeypatch.setattr(rep, "BUCKET_BYTES", 700)
        monkeypatch.setattr(rep, "HOT_LEAST", 3)
        monkeypatch.setattr(rep, "HOT_SHARE", 0.0)
    got = rep.remove_repeats(documents(spark, clash=True), 50).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == repeats(texts(), 50)


def test_repeats_in_shared_passages(spark):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))
    rows = []
    for i in range(40):
        own = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 150)))
        cut = rng.randrange(0, 30)
        rows.append((i * 3, own + passage[cut:] + own[::-1], "en", "s", 0))
    got = rep.remove_repeats(documents(spark, rows), 50).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == repeats(rows, 50)


def test_repeats_of_nothing_and_null_ids(spark):
    assert rep.remove_repeats(documents(spark, [])).count() == 0
    rows = [(None, BASE, "en", "s", 1), (None, BASE, "en", "s", 1), (5, BASE, "en", "s", 1), (5, BASE, "en", "s", 1)]
    assert [r.n_removed for r in rep.remove_repeats(documents(spark, rows)).collect()] == [0, 0, 0, 0]


def test_merging_in_runs_of_anchors_changes_nothing(monkeypatch):
    rng = random.Random(7)
    strings, entries = [], []
    for k in range(120):
        anchor = rng.randrange(6)
        body = bytes(65 + (anchor * 7 + i * i) % 23 for i in range(25))
        sides = [b"ab" * 12 + b"c", b"q" * 25, b"klmno" * 5]
        text = rng.choice(sides)[rng.randrange(2) :] + body + rng.choice(sides)[: rng.randrange(2, 26)]
        strings.append(text)
        entries.append((rng.randrange(40), anchor, len(text)))
    table = np.array(entries, dtype=rep._ENTRY)

    def found():
        index, start, end = rep.lost_stretches(table, b"".join(strings), 50)
        return sorted(zip(index.tolist(), start.tolist(), end.tolist()))

    whole = found()
    monkeypatch.setattr(rep, "MERGE", 200)
    assert found() == whole and whole


def test_merged_transforms_give_the_sorted_order():
    """Intervals of the merge are the groups of equal prefixes, in order."""
    rng = random.Random(4)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))).encode() for _ in range(30)]
    docs = np.arange(30)
    least = rep.earliest_documents(strings, docs, 10, shard_size=64)
    for s, found in zip(strings, least):
        want = [min(d for d, o in enumerate(strings) if s[p : p + 10] in o) for p in range(len(s) - 9)]
        assert found.tolist() == want


def test_cleaned_documents_are_valid_text(spark):
    out = rep.remove_from_documents(documents(spark, clash=True))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = {i: k.decode("utf-8", "ignore") for i, (_, _, _, k) in repeats(texts(), 50).items()}
    assert {r.doc_id: r.text for r in out.collect()} == want


def five_words(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("bucket", [512, 3])
def test_fingerprints_of_edits(spark, monkeypatch, bucket):
    monkeypatch.setattr(sketch, "BUCKET_ROWS", bucket)
    rows = sorted(texts())
    out = {r.doc_id: r for r in sketch.fingerprint_edits(documents(spark, clash=True)).collect()}
    for i, (doc_id, text, *_) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(text) // 4
        edited, r = text[: len(text) - m] + after[:m], out[doc_id]
        assert (r.n_chars, r.edited) == (len(text), edited)
        assert abs(r.near_edited - jaccard(five_words(text), five_words(edited))) < 0.2
        assert abs(r.near_next - jaccard(five_words(text), five_words(after))) < 0.2
        if len(five_words(text) | five_words(edited)) <= sketch.K:
            assert r.near_edited == pytest.approx(jaccard(five_words(text), five_words(edited)))
    assert out[0].sketch == out[1].sketch
    assert sketch.fingerprint_edits(documents(spark, [])).count() == 0


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(3)
    a = " ".join(f"a{rng.randrange(5000)}" for _ in range(2000))
    b = a + " " + " ".join(f"b{i}" for i in range(2000))
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        sketch.sketch(F.col("a")).alias("sa"), sketch.sketch(F.col("b")).alias("sb")
    )
    r = df.select(
        sketch.distinct_count(F.col("sa")).alias("n"),
        sketch.resemblance(F.col("sa"), F.col("sb")).alias("j"),
        sketch.containment(F.col("sa"), F.col("sb")).alias("c"),
    ).first()
    assert abs(r.n - 1996) < 500 and abs(r.j - 0.5) < 0.15 and r.c > 0.75
    parts = df.select(F.lit(1).alias("k"), F.col("sa").alias("sketch")).union(df.select(F.lit(1), "sb"))
    merged = sketch.merge_sketches(parts, ["k"]).first().sketch
    assert merged == df.select(sketch.merge(F.col("sa"), F.col("sb"))).first()[0]


def test_fingerprint_plan_has_no_python(spark):
    from tillroll.llm.queries import QUERIES

    plan = QUERIES["op5_document_fingerprints"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
