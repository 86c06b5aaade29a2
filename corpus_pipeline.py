"""Corpus pipeline: quality classifier, language ID, near-duplicate join,
repeat removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet to the checkpoint folder and reads it back as the next
stage's input, so each stage works on all that its predecessor kept and a
lost executor never reaches back further than one stage.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import langid, ngram_join, packing, repeats, rule_ensemble
from tillroll.llm.common import held_out, read_table, vocabulary
from tillroll.plans.materialize import delete_on_exit, drop_path, table_path, write_and_read

#: No SQL engine trains the models or tokenizes; the tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's cutoff."""
    return rule_ensemble.keep_predicted(docs.select(*COLUMNS), read_table(spark, sf_dir, "labels"))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language and reads like the training texts
    of that language (the posterior decides nothing here: it only compares the
    learned languages and is near 1 for any longer text)."""
    train = docs.where(~held_out())
    langs, logs = langid.fit(train)
    usual = write_and_read(langid.usual_range(train, langs, logs), "language_ranges")
    found = langid.predict(docs, langs, logs, keep=tuple(COLUMNS), measures=True)
    return langid.fits_language(found.where(F.col("lang_pred") != "und"), usual).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every group of linked documents (five-word
    shingles, similarity 0.8); documents without words are in no group."""
    return ngram_join.keep_representatives(docs.select(*COLUMNS), words=5, percent=80)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 50-byte strings that start in an earlier
    document; characters cut in the middle go as a whole."""
    return repeats.remove_from_documents(docs, length=50).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their place in 4096-token
    sequences."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", keep_good_quality),
    ("language_id", keep_known_language),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("suffix_array_dedup", remove_repeated_passages),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order.  A stage's table goes as soon as the next one is
    written, so at most two copies of the corpus are held."""
    docs, before = read_table(spark, sf_dir, "documents").select(*COLUMNS), None
    for name, stage in STAGES[:-1]:
        path = table_path(spark, f"pipeline_{name}")
        docs = write_and_read(stage(spark, docs, sf_dir), f"pipeline_{name}", path=path)
        if before is not None:
            drop_path(spark, before)
        before = path
    delete_on_exit(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
