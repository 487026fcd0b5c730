"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 64-bit hash. A source that needs a share of its words takes the documents below a
hash threshold. The threshold comes from histograms: words are summed by source and leading hash bits, a running
sum finds the bucket in which the budget ends, and only that bucket is refined by the next bits, until it holds one
hash value. No rows are sorted and no rows are collected: a level is one partial aggregation over three columns.
Thresholds of growing budgets are nested, so a larger mix contains every smaller one.

A target above the source's size is met by whole copies first; the threshold deals with the remainder. The
documents at the threshold hash itself are taken in part, so that a source's words equal its (rounded) target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Stages, broadcast_if_small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
# Hash bits per histogram level: a source has at most 2**LEVEL_BITS buckets, whatever its size.
LEVEL_BITS = 10
HASH_BITS = 63


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _join_key(c: str) -> Column:
    """Null sources are a source of their own: joins compare a prefixed text instead."""
    return F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(c)))


def source_targets(sizes: DataFrame, stages: Stages, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` per source.

    Sources in code-point order (null last) weigh ``weights`` in turn. Targets share the total of all sizes by
    weight; one above ``max_repeats`` times its source's size stops there and the excess is shared again among
    the others by weight. That is a common level: target = min(cap, level * weight). Each round is one small
    aggregate; the level only rises, so a capped source stays capped.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ordered = stages.put(totals.repartitionByRange(F.col("source").asc_nulls_last())
                         .sortWithinPartitions(F.col("source").asc_nulls_last()), "sources")
    # Rank = rows in earlier files + row in this file. The window is over one row per file, not per source.
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    placed = ordered.select("source", "source_size", part.alias("part"), F.col("_metadata.row_index").alias("row"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    rank = (F.col("base") + F.col("row")) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank + 1).cast("int"))
    ranked = stages.put(placed.join(files, "part").select("source", "source_size", weight.alias("weight"),
                                                          (F.col("source_size") * max_repeats).alias("cap")), "ranked")
    total = ranked.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    level, capped = 0.0, -1
    while True:
        is_capped = F.col("cap") <= F.col("weight") * level if capped >= 0 else F.lit(False)
        row = ranked.agg(F.sum(F.when(is_capped, F.col("cap")).otherwise(0)).alias("fixed"),
                         F.sum(F.when(is_capped, 0).otherwise(F.col("weight"))).alias("open"),
                         F.sum(F.when(is_capped, 1).otherwise(0)).alias("capped")).first()
        if row["capped"] == capped or not row["open"]:
            break
        capped, level = row["capped"], max(0, total - row["fixed"]) / row["open"]
    return ranked.select("source", "source_size",
                         F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(float(level))).alias("target"))


def _width() -> Column:
    return F.lit(100) + F.octet_length(KEY)


HASH, SIZE, KEY = "_mix_hash", "_mix_size", "_mix_key"


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """``docs`` with the hash, size and join key of every row."""
    return docs.withColumns({
        HASH: F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("long")), 1),
        SIZE: word_count(F.col(text_col).cast("string")), KEY: _join_key(source_col)})


def thresholds(sized: DataFrame, stages: Stages, weights, max_repeats: int) -> DataFrame:
    """Per source: target, whole copies, and the threshold hash with the words left for the rows at it.

    ``sized`` is a staged table of ``source`` and the columns of ``measured``.
    """
    words = F.round("target").cast("long")
    budgets = stages.put(
        source_targets(sized.withColumnRenamed(SIZE, "size"), stages, weights, max_repeats)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0))
        .withColumn("budget", words - F.col("whole") * F.col("source_size"))
        .withColumn(KEY, _join_key("source")).drop("source"), "budgets")
    edges, bits = budgets.select(KEY, F.col("budget").alias("left")), 0
    while bits < HASH_BITS:
        step = min(LEVEL_BITS, HASH_BITS - bits)
        inside = sized if not bits else sized.join(broadcast_if_small(edges, _width()), KEY).where(
            F.shiftright(HASH, HASH_BITS - bits) == F.col("prefix")).select(*sized.columns)
        buckets = inside.groupBy(KEY, F.shiftright(HASH, HASH_BITS - bits - step).alias("prefix")).agg(
            F.sum(SIZE).alias("words"), F.min(HASH).alias("low"), F.max(HASH).alias("high"))
        running = Window.partitionBy(KEY).orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        ends = buckets.withColumn("upto", F.sum("words").over(running)).join(
            edges.select(KEY, "left"), KEY).where(F.col("upto") > F.col("left"))
        found = F.struct("prefix", "words", "low", "high", (F.col("left") - F.col("upto") + F.col("words")).alias("left"))
        edges = stages.put(ends.groupBy(KEY).agg(F.min_by(found, "prefix").alias("b")).select(KEY, "b.*"),
                           f"edges{bits}")
        bits += step
        if edges.where(F.col("low") != F.col("high")).isEmpty():
            break
    edge = edges.select(KEY, F.col("low").alias("_mix_edge"), F.col("left").alias("_mix_left"),
                        F.col("words").alias("_mix_words"))
    return stages.put(budgets.drop("budget").withColumnsRenamed(
        {"whole": "_mix_whole", "target": "_mix_target", "source_size": "_mix_source_size"}).join(edge, KEY, "left"),
        "plan")


def with_taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Measured rows with ``_mix_taken``: 'left' words go to the rows at the threshold hash, which hold 'words'."""
    part = (F.when(F.col(HASH) < F.col("_mix_edge"), F.col(SIZE))
            .when(F.col(HASH) == F.col("_mix_edge"),
                  F.floor(F.col(SIZE).cast("decimal(20,0)") * F.col("_mix_left") / F.col("_mix_words")))
            .otherwise(0)).cast("long")
    return rows.join(broadcast_if_small(plan, _width()), KEY).withColumn("_mix_taken", F.col("_mix_whole") * F.col(SIZE) + part)


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 20) -> DataFrame:
    """``doc_id, source, hash, size, source_size, target, taken`` for every row of ``docs``.

    ``taken`` counts the words the mix takes of the row: whole copies, plus one more copy of rows whose hash is
    below the source's threshold, plus part of the rows at the threshold hash. It never exceeds
    ``max_repeats * size``. The hash depends on the id and the seed alone, so reruns agree and equal ids (repeated
    rows, null ids) share a hash; when they stand at the threshold, the remaining budget is split by size.
    Null texts have size 0; a source without words has target 0; an empty table gives no rows.
    """
    stages = Stages(docs.sparkSession, "mixing")
    sized = stages.put(measured(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                                            F.col(source_col).cast("string").alias("source")),
                                "doc_id", "text", "source", seed).drop("text"), "sized")
    done = with_taken(sized, thresholds(sized, stages, weights, max_repeats))
    stages.keep("sized", "plan")
    return done.select("doc_id", "source", F.col(HASH).alias("hash"), F.col(SIZE).alias("size"),
                       F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
                       F.col("_mix_taken").alias("taken"))


def first_words(text: Column, count: Column) -> Column:
    """The text up to its ``count``-th word."""
    return F.array_join(F.slice(F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), count.cast("int")), "")


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 20) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, with all their columns.

    A row taken in part gives one more row with its first words. The texts are not shuffled (unless the sources are
    too many to broadcast): what a row gives follows from its hash and its source's threshold.
    """
    stages = Stages(docs.sparkSession, "mixing")
    rows = measured(docs, id_col, text_col, source_col, seed)
    sized = stages.put(rows.select(F.col(source_col).cast("string").alias("source"), HASH, SIZE, KEY), "sized")
    done = with_taken(rows, thresholds(sized, stages, weights, max_repeats)).where("_mix_taken > 0")
    stages.keep("plan")
    rest = F.col("_mix_taken") % F.col(SIZE)
    copies = F.ceil(F.col("_mix_taken") / F.col(SIZE)).cast("int")
    done = done.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), copies)))
    cut = (F.col("_mix_copy") == copies) & (rest > 0)
    return done.withColumn(text_col, F.when(cut, first_words(F.col(text_col), rest)).otherwise(F.col(text_col))).select(
        *docs.columns)
