"""Packing, BPE and token counts against the libraries themselves."""

import hashlib
import zlib

import numpy as np
import pytest
from cases import documents, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import bpe, packing, token_count
from tillroll.llm.common import file_bytes, vocabulary

TRICKY = st.text(alphabet="aab eé\n\t  \x1c\x85'sSTt<|endoftext|>漢🙂0 ▁", max_size=60)


@pytest.fixture(scope="module")
def byte_bpe():
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    return bpe.ByteBPE(file_bytes(path)), Tokenizer.from_file(path)


@settings(max_examples=300, deadline=None)
@given(TRICKY)
def test_bpe_round_trip(byte_bpe, text):
    mine, library = byte_bpe
    ids = np.frombuffer(mine.encode(text), "<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert mine.decode(mine.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_pair_tree_merges_leftmost_lowest_rank():
    merges = {0 << 32 | 0: (1, 1), 1 << 32 | 0: (0, 2), 2 << 32 | 0: (5, 3)}
    assert bpe.merge_pairs([0, 0, 0, 0, 0], merges) == [2, 1]
    assert bpe.merge_pairs([7, 8], merges) == [7, 8]


def test_encode_and_decode_documents(spark, byte_bpe):
    path = vocabulary("byte_bpe_50k.json")
    out = bpe.decode(bpe.encode(documents(spark, clash=True), path), path).collect()
    want = {r[0]: r[1] or "" for r in texts()}
    assert {r.doc_id: r.decoded for r in out} == want
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == byte_bpe[1].encode(want[r.doc_id], add_special_tokens=False).ids
    assert bpe.encode(documents(spark, []), path).count() == 0


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    return token_count.Transducer(token_count.Vocabulary.load(path)), sentencepiece.SentencePieceProcessor(model_file=path)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aab eé\n▁<s>0x漢🙂 théin", max_size=80))
def test_transducer_counts(pieces, text):
    assert pieces[0].count(text) == len(pieces[1].encode(text))


def test_transducer_long_words_compose_by_scan(pieces):
    for text in ("abc" * 2000, "a" * 1500, "漢字x" * 700, "the" * 999 + " end " + "q" * 600):
        assert pieces[0].count(text) == len(pieces[1].encode(text))


def test_transducers_are_kept_by_content():
    class Shared:  # a new broadcast object, as a reused worker sees one
        def __init__(self, value):
            self.value = value

    one = token_count.Vocabulary({"a": 0.0}, True, "one")
    two = token_count.Vocabulary({"a": 0.0, "aa": -1.0, "▁": -2.0}, True, "two")
    first = token_count._transducer(Shared(one))
    assert token_count._transducer(Shared(one)) is first
    assert token_count._transducer(Shared(two)).scores == two.scores


def test_prefix_scan_equals_one_run(pieces):
    t = pieces[0]
    text = token_count.MARK + "internationalization" * 30
    blocks = [text[i : i + 50] for i in range(0, len(text), 50)]
    maps = [token_count.StateMap(t, [blocks[0]], fixed=t.run(blocks[0]))]
    maps += [token_count.StateMap(t, [b]) for b in blocks[1:]]
    assert token_count.prefix_scan(maps)[-1].fixed == t.run(text)


def test_count_documents(spark, pieces):
    out = token_count.count_tokens(documents(spark, clash=True), vocabulary("piece_bpe_32k.model"), limit=100).collect()
    want = {r[0]: r[1] or "" for r in texts()}
    for r in out:
        n = len(pieces[1].encode(want[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(want[r.doc_id].encode()), n, n > 100)
    assert len(out) == len(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(TRICKY, max_size=4))
def test_chunk_tokenizer(texts):
    mine, library = _word_tokenizers()
    for text, ids in zip(texts, mine.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_word_of_the_vocabulary():
    """Whole words merge in tiktoken as in the library, for all of them."""
    import json

    path = vocabulary("word_bpe_49k.json")
    mine, library = _word_tokenizers()
    stems = {t.removesuffix("</w>") for t in json.loads(file_bytes(path))["model"]["vocab"]}
    stems = sorted(t for t in stems if t.isascii() and t.isalpha())
    want = library.encode(" ".join(stems), add_special_tokens=False).ids
    assert len(stems) > 20_000
    assert np.frombuffer(b"".join(mine.encode([" ".join(stems)])), "<u4").tolist() == want


def _word_tokenizers(made=[]):
    if not made:
        from tokenizers import Tokenizer

        path = vocabulary("word_bpe_49k.json")
        made += [packing.ChunkTokenizer(file_bytes(path)), Tokenizer.from_file(path)]
    return made


def test_place_by_squares_fills_exactly():
    sizes = np.array([6, 5, 5, 4, 4, 3, 3])
    sequence, offset = packing.place_by_squares(sizes, 10)
    for s in set(sequence.tolist()):
        at = sorted(zip(offset[sequence == s], sizes[sequence == s]))
        end = 0
        for o, n in at:
            assert o == end
            end += n
        assert end <= 10
    assert len(set(sequence.tolist())) == 3


def test_squares_choose_the_smallest_sum():
    """Every choice gives the smallest sum of squared counts of open gaps."""
    rng = np.random.default_rng(3)
    sizes, size = rng.integers(1, 40, 300), 64
    sequence, _ = packing.place_by_squares(sizes, size)
    gap = {}
    for s, n in zip(sequence.tolist(), sizes.tolist()):
        def total(choice):
            gaps = dict(gap)
            gaps[choice] = gaps.get(choice, size) - n
            counts = np.bincount([g for g in gaps.values() if g > 0], minlength=1)
            return int((counts**2).sum())

        fits = [k for k, g in gap.items() if g >= n]
        assert (s in fits) if fits else (s not in gap)
        if fits:
            assert total(s) == min(map(total, fits))
        gap[s] = gap.get(s, size) - n


def test_pack_documents(spark):
    rows = texts() + [texts()[0]]  # a repeated row
    path = vocabulary("word_bpe_49k.json")
    out = packing.pack_documents(documents(spark, rows, clash=True), path, size=64).toPandas()
    _, library = _word_tokenizers()
    want = set()
    for doc_id, text, *_ in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want.add((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    assert set(out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        assert (part["offset"].to_numpy() == np.r_[0, part["length"].cumsum().to_numpy()[:-1]]).all()
        assert part["length"].sum() <= 64
    assert out["sequence_id"].nunique() <= -(-out["length"].sum() // 64) + 1
    assert packing.pack_documents(documents(spark, []), path).count() == 0


def test_digests_of_the_query(spark):
    from tillroll.llm.queries import QUERIES

    r = QUERIES["op2_bpe_round_trip"](spark, "/root/testdata/sf0.001").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(f"doc_id = {r.doc_id}").first().text
    assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
