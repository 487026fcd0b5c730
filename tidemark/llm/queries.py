"""One registered query per operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bitsliced, imatch, jaccard, licences, mixing, packing, pseudonyms, quality, repeats, spelling, warc, whitening, windows)
from tidemark.llm.common import read, workers_import

WORD_VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str = WORD_VOCABULARY) -> str:
    """Path of a public vocabulary file (installed with the tokenizers, never copied here)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_edits(read(spark, sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("text_hash")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read(spark, sf_dir, "pages"), keep_archives=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the remaining bytes as ``text`` (a cut may fall within a character: those bytes are replaced there)."""
    done = repeats.remove_repeats(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


# Key of the registered query and the pipeline; a real run passes its own secret.
PSEUDONYM_KEY = b"tidemark demonstration key"


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pseudonymised texts, with the number of spans and their kinds."""
    done = pseudonyms.replace_private(read(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    return done.select("doc_id", "text", F.size("private").cast("long").alias("n_private"),
                       F.array_sort(F.array_distinct("private.kind")).alias("kinds"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def op12_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.remove_repeated_windows(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", "text")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return done.select("vec_id", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of"),
                       "identity_error").select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "of.whitened", "of.explained", "identity_error")


OPERATORS = (op1_packing, op2_imatch, op3_topk, op4_mixing, op5_quality, op6_jaccard, op7_warc, op8_repeats, op9_pii,
             op10_licences, op11_spelling, op12_windows, op13_whitening)


def _registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_import(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _registered(f) for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {}
