"""From raw documents to packed training sequences: language, near copies, personal data, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, language_crf, mixing, packing, pii
from tidemark.llm.queries import BYTE_BPE_END, PACK_CAPACITY, PII_KEY, tokenizer_path
from tidemark.llm.shared import table, written

#: Language ID needs training and random choices, so SQL can't express it; tests hold run() against a plain version.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without text or a letter go, all where no language is labelled.

    Null ids, repeated rows and other columns stay as they are; an empty table stays empty.
    """
    model = language_crf.train(docs)
    others = tuple(c for c in docs.columns if c != "doc_id")
    found = language_crf.predict(docs, model, keep=others, names=("_lang_pred", "_lang_score"))
    return found.filter(F.col("_lang_pred") != "und").select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by the Jaccard similarity of their shingles, the one with the smallest id."""
    return jaccard_join.deduplicated(docs).select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same format."""
    return pii.pseudonymised(docs, PII_KEY).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, repeats included."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(packing.pieces_of(docs, tokenizer_path("byte_bpe_50k.json"), BYTE_BPE_END, PACK_CAPACITY), PACK_CAPACITY)


STAGES = [("language", known_language), ("near copies", without_near_copies), ("personal data", without_personal_data), ("source mix", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
