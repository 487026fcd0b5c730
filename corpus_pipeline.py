"""The corpus pipeline: documents to training sequences, each stage one operator of ``tidemark.llm``.

A stage takes all rows its predecessor kept and returns them with the columns of documents, changed, dropped or
repeated; the last one returns the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, mixing, packing, pseudonyms, quality
from tidemark.llm.common import Stages, read, workers_import
from tidemark.llm.queries import PSEUDONYM_KEY, vocabulary

# No stage can be stated in SQL (trained model, keyed permutation, token ids); the tests compare with brute force.
ORACLE_SQL = None

# Near copies in this pipeline: similarity of 0.8 over five-word shingles. op6_jaccard has its own rule (4 words, 0.85).
NEAR_WORDS = 5
NEAR_PERCENT = 80


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold go."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return jaccard.one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by pseudonyms."""
    return _with_length(pseudonyms.replace_private(docs, PSEUDONYM_KEY).drop("private"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one taken in part gives its first words."""
    return _with_length(mixing.mixed(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: pieces of one document each, of power-of-two length.

    The executors still hold what the stages before have left in memory, so the word table is kept small.
    """
    return packing.pack(docs, vocabulary(), most_words=300_000, batch_bytes=512 * 1024)


STAGES = [("quality classifier", quality_classifier), ("n-gram Jaccard join", jaccard_join), ("PII", pii),
          ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read back as the documents of the next."""
    workers_import(spark)
    stages, docs = Stages(spark, "pipeline"), read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stages.put(docs, f"documents-{k + 1}")
    return docs
