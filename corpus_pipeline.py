"""A corpus pipeline of five stages over the documents table, from raw texts to packed training sequences.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; each stage works on all that the one before kept.
All but the last return the columns of documents. Null texts, empty texts, texts without letters and those in no
learned language go in the first stage; repeated rows go in the second. An empty table passes through as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cuesheet.llm import exact_dedup, langid, packing, secrets, simhash
from cuesheet.llm.common import materialise, prepare
from cuesheet.scratch import spread

#: Words of a shingle, and the Jaccard similarity of sets of shingles from which documents are near copies.
NEAR_WORDS = 5
NEAR_SIMILARITY = 0.8


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letters, no main language, or words unlike those of any language learned from labels."""
    prepare(spark)
    return langid.keep_identified(docs, langid.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    prepare(spark)
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that four fifths of shingles or more link, the one with the smallest doc_id stays."""
    prepare(spark)
    return simhash.drop_near_copies(docs, NEAR_WORDS, NEAR_SIMILARITY)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; all documents stay, n_chars follows the text."""
    prepare(spark)
    return secrets.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their ids."""
    prepare(spark)
    return packing.packed_ids(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language id", identified),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: Language identification and packing are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
