"""Corpus pipeline: STAGES over ``documents``.

Each stage is a function (spark, docs, sf_dir) that calls one operator of
shoplens.llm on all that its predecessor kept; its result is written as
Parquet in the shared folder and read again as the next stage's docs. All
stages but the last return the columns of ``documents``; the last returns the
packed pieces. Null or repeated ids, null texts and further columns pass
through every stage as the operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import _common as C
from shoplens.llm import decontaminate, language_id, packing, simhash, suffix_dedup
from shoplens.session import scratch_path

#: A text whose best language has less than this share of belief is rejected.
LEAST_LANGUAGE_SCORE = 0.3

#: Strings of so many bytes are removed where they repeat: 50 words of four
#: letters and a space, so that a passage of more words holds at least one.
PASSAGE_BYTES = 250


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a learned language: texts without a letter (null
    and empty ones too) go, and texts that no language clearly explains best."""
    model = language_id.fit(docs.where(~language_id.held_out()).select("doc_id", "text", "lang"))
    name = C.fresh_name(docs, "language")
    found = language_id.predict(docs, model, name=name)
    sure = (F.col(f"{name}.lang_pred") != language_id.UNDETERMINED) & (F.col(f"{name}.score") >= LEAST_LANGUAGE_SCORE)
    return found.where(sure).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group."""
    return simhash.keep_one(docs)


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, without the characters of strings of
    PASSAGE_BYTES bytes that also start elsewhere; n_chars follows the text."""
    counted = "n_chars" if "n_chars" in docs.columns else None
    return suffix_dedup.remove_repeats(docs, length=PASSAGE_BYTES, count_col=counted)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are not contaminated by ``benchmark``."""
    return decontaminate.remove_documents(docs, C.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", remove_repeated_strings),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: SQL cannot express the language model, the fingerprints or the packing; the
#: stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        place = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
