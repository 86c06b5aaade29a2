"""Cross-tokenizer alignment against the libraries and plain loops."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from cases import documents, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import alignment as A
from tillroll.llm import queries
from tillroll.llm.common import file_bytes, vocabulary

PATH_A, PATH_B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
TRICKY = st.text(alphabet="aab eé\n\t  \x1c\x85'sSTt<|endoftext|>漢🙂0 ▁<s>x", max_size=50)


@pytest.fixture(scope="module")
def sides():
    return A.ByteTokens(file_bytes(PATH_A)), A.PieceTokens(file_bytes(PATH_B))


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def plain_groups(libraries, text):
    """[(A ids, B ids)] of each group, by walking both token lists."""
    if not text:
        return []
    a, b = libraries
    byte_of = {c: x for x, c in A.byte_alphabet().items()}
    left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    data = (" " + text).encode()
    if b"".join(x[1] for x in left) != data or b"".join(x[1] for x in right) != data:
        return []
    ends = [set(np.cumsum([len(x[1]) for x in side]).tolist()) for side in (left, right)]
    out, place = [], [0, 0]
    cuts = sorted(ends[0] & ends[1])
    for cut in cuts:
        group = []
        for k, side in enumerate((left, right)):
            ids = []
            while side and place[k] < cut:
                i, token = side.pop(0)
                ids.append(i)
                place[k] += len(token)
            group.append(ids)
        out.append(tuple(group))
    return out


def listing(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def brute(libraries, rows):
    """Per row (n_a, n_b, n_groups, n_links, n_best, count_sum, listing)."""
    found = [plain_groups(libraries, t) for t in rows]
    links = [Counter((x, y) for g in f for x in g[0] for y in g[1]) for f in found]
    counts = Counter(p for c in links for p in c)
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    return [
        (
            sum(len(g[0]) for g in f), sum(len(g[1]) for g in f), len(f), sum(c.values()),
            sum(n for p, n in c.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in c.items()), listing(f),
        )
        for f, c in zip(found, links)
    ]


ENDS = st.lists(st.integers(1, 60), max_size=30, unique=True).map(sorted)


@settings(max_examples=300, deadline=None)
@given(ENDS, ENDS, st.integers(1, 9))
def test_merge_path_and_groups(a, b, work):
    a, b = np.array([*a, 99]), np.array([*b, 99])
    at_a, at_b = A.merge_path(a, b, work)
    merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    for i, j in zip(at_a.tolist(), at_b.tolist()):
        assert sum(1 for m in merged[: i + j] if m[1] == 0) == i
    assert all(n <= work for n in (np.diff(at_a) + np.diff(at_b)).tolist())
    common = sorted(set(a.tolist()) & set(b.tolist()))
    for ends, got in zip((a, b), A.group_numbers(a, b, work)):
        assert got.tolist() == [sum(c < e for c in common) for e in ends.tolist()]


@settings(max_examples=150, deadline=None)
@given(st.lists(TRICKY, max_size=5))
def test_texts_equal_plain_walk(sides, libraries, rows):
    found = A.Aligned(*sides, rows, work=8)
    names = A._names(sides[0], "|"), A._names(sides[1], ";")
    lists = list(found.listings(*names))
    size = len(sides[1].bytes_of)
    text, pair, times = found.pairs(size)
    for k, row in enumerate(rows):
        groups = plain_groups(libraries, row)
        assert lists[k].decode() == listing(groups)
        assert found.n_groups[k] == len(groups)
        mine = text == k
        want = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        assert {divmod(p, size): n for p, n in zip(pair[mine].tolist(), times[mine].tolist())} == dict(want)
        assert found.n_links[k] == sum(want.values())


def test_large_groups_by_distinct_ids(sides, libraries, monkeypatch):
    rows = ["<|endoftext|> naïve 漢字", None, "", texts()[9][1]]
    whole = A.Aligned(*sides, rows).pairs(32_000)
    monkeypatch.setattr(A, "PLAIN_LINKS", 1)
    for x, y in zip(whole, A.Aligned(*sides, rows).pairs(32_000)):
        assert x.tolist() == y.tolist()


def test_long_runs(sides, libraries):
    for text in (" " * 7000 + "x", "ab" * 6000, "\n \t" * 3000 + "é"):
        assert A.ByteTokens.ids(sides[0], [text])[0].tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids


@pytest.mark.parametrize("most", [A.MOST_PAIRS, 40])
def test_documents_equal_brute_force(spark, libraries, most):
    rows = [*texts(), (0, texts()[0][1], "en", "s", 1), (None, texts()[2][1], "en", "s", 1), (60, "▁ a▁b", "en", "s", 1)]
    docs = documents(spark, rows, clash=True)
    got = A.cross_alignment(docs, PATH_A, PATH_B, keep=("doc_id", "text", "start"), most_pairs=most).collect()
    want = dict(zip([r[1] for r in rows], brute(libraries, [r[1] for r in rows])))
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == want[r.text]


def test_empty_table(spark):
    assert A.cross_alignment(documents(spark, []), PATH_A, PATH_B).count() == 0
    none = A.cross_alignment(documents(spark, [texts()[4], texts()[5]]), PATH_A, PATH_B).collect()
    assert [tuple(r)[1:] for r in none] == [(0, 0, 0, 0, "", 0, 0)] * 2


def test_query_equals_brute_force(spark, libraries):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = dict(zip([d.doc_id for d in docs], brute(libraries, [d.text for d in docs])))
    got = queries.op11_cross_tokenizer_alignment(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        *numbers, groups = want[r.doc_id]
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum] == numbers
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
