"""Spelling variants by reduced-alphabet neighbourhood generation.

1. Words. Runs of letters are counted over all documents (partial sums before the shuffle), so from here on rows are
   distinct words.
2. Reduction. Every letter is hashed to one of a few symbols; two words that differ by one edit have reduced words that
   are equal or differ by one edit. The full one-edit neighbourhood of every distinct reduced word (itself, deletions,
   replacements, insertions) is generated over the small alphabet and joined with the reduced vocabulary. The number of
   symbols follows the vocabulary, so that a reduced word stands for about one word of its length at every size.
3. Verification. The words behind two neighbouring reduced words are compared by edit distance on the original strings.
   A pair of reduced words behind which very many words stand is not expanded: its words are reduced again with
   more symbols, at last with a symbol per letter, where a reduced word is the word itself. No pair is lost or capped.
4. Forms. A word's form is its commonest near word, if common enough; roots follow forms by pointer doubling.

Everything is DataFrame code. Keys are 64-bit hashes of reduced words; a collision only adds a comparison.
"""

from __future__ import annotations

import math
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, Stages

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
LEAST_SYMBOLS = 4
# Comparisons that one pair of reduced words may stand for before its words are reduced with more symbols.
MOST_COMPARISONS = 4096

WORDS_PER_TASK = 20_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
# Symbols of reduced words; with one per letter the reduced word is the word.
SYMBOLS = LETTERS


# ---- 1. words -----------------------------------------------------------------------------

def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_length: int = LEAST_LENGTH) -> DataFrame:
    """``doc, run``: every maximal run of at least ``least_length`` letters, A-Z in lower case."""
    pattern = f"[A-Za-z\\u00C0-\\u00FF]{{{least_length},}}"
    found = F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))
    return docs.select(F.col(id_col).cast("string").alias("doc"), F.explode(found).alias("run")).select(
        "doc", F.translate("run", UPPER, LOWER).alias("run"))


def misspelt(runs: DataFrame, every: int = 31) -> DataFrame:
    """``word`` of every run: where ``every`` divides the run's hash with its document, one letter is left out."""
    h = F.crc32(F.concat(F.coalesce("doc", F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(
        F.col("n") >= least_count)


# ---- 2. reduction -------------------------------------------------------------------------

def reducing(symbols: int) -> str:
    """The symbol of every letter, in the order of ``LETTERS``."""
    if symbols >= len(LETTERS):
        return SYMBOLS
    # letters in the order of their hash, those without accents first, are dealt out over the symbols
    place = {c: k for k, c in enumerate(sorted(LETTERS, key=lambda c: (not c.isascii(), crc32(c.encode()), c)))}
    return "".join(SYMBOLS[place[c] % symbols] for c in LETTERS)


def symbols_for(lengths: list[tuple[int, int]], least: int = LEAST_SYMBOLS) -> int:
    """The fewest symbols that make as many reduced words of every length as there are words."""
    return min(len(LETTERS), max([least] + [math.ceil(n ** (1 / length) - 1e-9) for length, n in lengths]))


def neighbourhood(word: Column, symbols: int) -> Column:
    """All distinct strings over the symbols within one edit of ``word``, itself included."""
    length = F.length(word)
    alphabet = F.array(*[F.lit(s) for s in SYMBOLS[:symbols]])
    nothing = F.array().cast("array<string>")

    def head(i: Column) -> Column:
        return F.substring(word, F.lit(1), i)

    def tail(i: Column) -> Column:
        return F.substring(word, i + 1, length)

    # at every place 0 to length: a symbol put in, put instead of the next one, or the next one taken away
    inserted = F.transform(F.sequence(F.lit(0), length), lambda i: F.transform(
        alphabet, lambda a: F.concat(head(i), a, tail(i))))
    replaced = F.transform(F.sequence(F.lit(0), length - 1), lambda i: F.transform(
        alphabet, lambda a: F.concat(head(i), a, tail(i + 1))))
    deleted = F.transform(F.sequence(F.lit(0), length - 1), lambda i: F.concat(head(i), tail(i + 1)))
    return F.when(length > 0, F.array_distinct(F.concat(F.flatten(inserted), F.flatten(replaced), deleted))).otherwise(
        F.concat(alphabet, nothing))


def reduced_pairs(words: DataFrame, symbols: int, stages: Stages, name: str) -> tuple[DataFrame, DataFrame]:
    """Words with the hash ``h`` of their reduced word, and pairs ``a, b`` of hashes within one edit."""
    code = F.translate("word", LETTERS, reducing(symbols))
    coded = stages.put(words.select("word", "n", code.alias("code"), F.xxhash64(code).alias("h")), f"{name}-coded")
    sizes = coded.groupBy("h").agg(F.count("*").alias("c"))
    # hashes of different reduced words may be equal, so the neighbourhoods are those of the words
    # by hash into tasks of so many words: their neighbourhoods are a hundred times as many rows
    tasks = max(8, coded.count() // WORDS_PER_TASK)
    codes = coded.select("h", "code").repartition(tasks, "h", "code").distinct()
    near = codes.select(F.col("h").alias("a"), F.explode(neighbourhood(F.col("code"), symbols)).alias("s")).select(
        "a", F.xxhash64("s").alias("b"))
    sizes = stages.put(sizes, f"{name}-sizes")
    present = broadcast_if_small(sizes, 16)
    pairs = near.join(present.select(F.col("h").alias("b"), F.col("c").alias("c_b")), "b").join(
        present.select(F.col("h").alias("a"), F.col("c").alias("c_a")), "a")
    return coded.drop("code"), stages.put(pairs.select("a", "b", (F.col("c_a") * F.col("c_b")).alias("c")).distinct(), f"{name}-pairs")


# ---- 3. near words ------------------------------------------------------------------------

def near_words(words: DataFrame, stages: Stages, symbols: int, most: int = MOST_COMPARISONS) -> DataFrame:
    """``word, near, near_n``: every ordered pair of words (``word, n``) that differ by exactly one edit."""
    found, level, rest = [], 0, words
    while True:
        coded, pairs = reduced_pairs(rest, symbols, stages, f"level-{level}")
        light = pairs.where(F.col("c") <= most)
        sides = coded.select(F.col("h").alias("a"), "word").join(light, "a").join(
            coded.select(F.col("h").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n")), "b")
        one_edit = (F.col("word") != F.col("near")) & (F.abs(F.length("word") - F.length("near")) <= 1) & (
            F.levenshtein("word", "near", 1) == 1)
        found.append(stages.put(sides.where(one_edit).select("word", "near", "near_n"), f"level-{level}-near"))
        heavy = pairs.where(F.col("c") > most)
        stages.drop(*([f"level-{level - 1}-coded"] if level else []))
        if symbols >= len(LETTERS) or heavy.isEmpty():
            break
        # words of heavy pairs only; pairs among them that were found already are made distinct below
        often = heavy.select(F.explode(F.array("a", "b")).alias("h")).distinct()
        rest = coded.join(often, "h", "left_semi").select("word", "n")
        symbols, level = min(len(LETTERS), symbols * symbols), level + 1
    if len(found) == 1:
        return found[0]
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return stages.put(every.distinct(), "near")


# ---- 4. forms and roots -------------------------------------------------------------------

def roots(forms: DataFrame, stages: Stages, ratio: int) -> DataFrame:
    """``word, root`` of the rows ``word, form, form_n``, by doubling; a form's count grows by ``ratio`` at each step."""
    top = forms.agg(F.max("form_n")).first()[0] or 1
    steps = math.floor(math.log(top, ratio)) + 1 if ratio > 1 else None
    current = forms.select("word", F.col("form").alias("root"))
    length, k = 1, 0
    while steps is None or length < steps:
        jump = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stages.put(current.join(jump, "root", "left").select("word", F.coalesce("next", "root").alias("root")),
                           f"roots-{k}")
        if steps is None and after.exceptAll(current).isEmpty():
            return after
        current, length, k = after, length * 2, k + 1
    return current


def spelling_forms(words: DataFrame, *, ratio: int = RATIO, symbols: int | None = None,
                   most_comparisons: int = MOST_COMPARISONS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a vocabulary ``word, n`` of distinct words.

    Words are near if they differ by exactly one inserted, deleted or replaced code point. The form is the near word of
    the largest n (ties: the smallest in code-point order) if that n is at least ``ratio`` times the word's (``ratio`` at
    least 2, so that chains of forms end). Null words give no row.
    """
    if ratio < 2:
        raise ValueError("the ratio must be at least 2")
    stages = Stages(words.sparkSession, "spelling")
    words = stages.put(words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")), "words")
    if symbols is None:
        lengths = words.groupBy(F.length("word").alias("l")).agg(F.count("*").alias("c")).where("l > 0")
        symbols = symbols_for([(r["l"], r["c"]) for r in lengths.collect()])
    near = near_words(words, stages, symbols, most_comparisons)
    # as a struct of the negated count and the word, the least one is the commonest, then the first
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    is_form = -F.col("best.m") >= ratio * F.col("n")
    joined = stages.put(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.m")).alias("form_n")), "forms")
    chained = roots(joined.where("form IS NOT NULL"), stages, ratio)
    return joined.join(chained, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
                      least_count: int = LEAST_COUNT, every: int = 31, **options) -> DataFrame:
    """``spelling_forms`` of the words of whole texts, with the letters that ``misspelt`` leaves out.

    Null texts have no words, a null id counts as an empty one, repeated rows count again; an empty table gives no rows;
    other columns are not read.
    """
    return spelling_forms(vocabulary(misspelt(letter_runs(docs, id_col, text_col, least_length), every), least_length,
                                     least_count), **options)
