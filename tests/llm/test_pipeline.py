"""The pipeline's stages, each held against a brute-force version."""

import sys
import zlib

import corpus_pipeline as C
from cases import components, documents, repeats, texts

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        seen[name] = (docs.collect(), after.collect())
        if name != "best_fit_packing":
            assert after.columns == columns
        docs = after
    before, after = seen["quality_classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    before, after = seen["language_id"]
    assert {r.doc_id for r in before} >= {r.doc_id for r in after} and len(after) >= 0.97 * len(before)
    before, after = seen["ngram_jaccard_join"]
    groups = components([(r.doc_id, r.text) for r in before], 5, 80)
    assert {r.doc_id for r in after} == {i for i, (_, c) in groups.items() if i == c}
    before, after = seen["suffix_array_dedup"]
    want = repeats([(r.doc_id, r.text) for r in before], 50)
    assert {r.doc_id: r.text for r in after} == {i: k.decode("utf-8", "ignore") for i, (_, _, _, k) in want.items()}
    before, after = seen["best_fit_packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert max(r.offset + r.length for r in after) <= 4096


def test_stages_on_awkward_and_empty_tables(spark):
    """Nulls, ties, repeated rows and extra columns whose names the operators
    use inside; then no rows at all."""
    rows = [*texts(), texts()[0], (None, "no id here " * 30, None, None, None), (3, None, None, None, None)]
    for made in (rows, []):
        docs = documents(spark, made, clash=True)
        ids = {r[0] for r in made}
        for name, stage in C.STAGES:
            out = stage(spark, docs, SF)
            found = out.collect()
            assert {r.doc_id for r in found} <= ids
            if name == "best_fit_packing":
                assert {r.doc_id for r in found} == ids
            else:
                assert out.columns == C.COLUMNS and len(found) <= len(made)
            if name == "ngram_jaccard_join" and made:
                kept = [r.doc_id for r in found if r.doc_id is not None]
                assert len(kept) == len(set(kept)) and 1 not in kept and 14 in kept
            if name == "suffix_array_dedup":
                assert len(found) == len(made)


def test_pipeline_leaves_one_copy_of_the_corpus(spark):
    import glob

    from tillroll.plans.materialize import checkpoint_dir

    held = lambda: set(glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/tables/pipeline_*"))
    before = held()
    out = C.run(spark, SF)
    assert len(held() - before) == 1 and out.count() > 0


def test_language_stage_rejects_unlearned_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*C.COLUMNS)
    planted = [
        "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. " * 5,
        "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。" * 10,
        "xqzjkvw qqxzjw kkvxq zzxqj wvkqx jqzxv " * 20,
    ]
    # Ids of the held-out fold: the planted texts are not learned.
    ids = [i for i in range(10**9, 10**9 + 100) if zlib.crc32(str(i).encode()) % 4 == 2][: len(planted)]
    rows = [(i, t, "en", "planted", len(t)) for i, t in zip(ids, planted)]
    added = spark.createDataFrame(rows, docs.schema)
    kept = {r.doc_id for r in C.keep_known_language(spark, docs.union(added), SF).select("doc_id").collect()}
    assert not kept & set(ids)
    assert len(kept) >= 0.97 * docs.count()


def test_entry_registers_every_operator():
    import __spark_entry__ as E

    names = set(E.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "tillroll.llm" in sys.modules
