"""Registered queries of the text operators (one per operator).

Each reads whole tables of ``sf_dir`` with production parameters and derives
its digest columns from the operator's general output.  ``ORACLE_SQL`` holds
DuckDB SQL where there is one; the others (trained models, tokenizers, suffix
structures) have none that could run on whole tables, and ``tests/llm`` holds
each against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    alignment,
    bpe,
    contamination,
    langid,
    ngram_join,
    packing,
    repeats,
    rule_ensemble,
    runs,
    sketch,
    token_count,
    wrapper,
)
from tillroll.llm.common import held_out, read_table, vocabulary
from tillroll.llm.risk_rules import quality_rules


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(read_table(spark, sf_dir, "documents"), length=50)
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper.extract_pages(read_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketch.fingerprint_edits(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch.fingerprint(F.col("sketch")).alias("fingerprint"),
        sketch.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"), words=3, percent=90)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.language_id(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = rule_ensemble.quality_classifier(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.cross_alignment(
        read_table(spark, sf_dir, "documents"),
        vocabulary("byte_bpe_50k.json"),
        vocabulary("piece_bpe_32k.model"),
        digest=True,
    )
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(runs.with_planted_repeats(read_table(spark, sf_dir, "documents")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_language_id": op7_language_id,
    "op8_token_counts": op8_token_counts,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_benchmark_decontamination": op12_benchmark_decontamination,
    "op13_periodic_runs": op13_periodic_runs,
}

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op12_benchmark_decontamination": f"""
        WITH docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
        items AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
        item_windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
            FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i)
            WHERE len(w) > 0
        ),
        doc_windows AS (
            SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
            FROM docs, (SELECT DISTINCT n FROM item_windows), unnest(range(1, len(w) - n + 2)) AS t(i)
        ),
        hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, win)),
        hit_words AS (
            SELECT doc_id, count(DISTINCT i + k) AS n_hit
            FROM (SELECT DISTINCT doc_id, i, n FROM hits), unnest(range(0, n)) AS t(k) GROUP BY doc_id
        ),
        hit_items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(list, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
}
