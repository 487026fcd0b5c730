"""I-Match document fingerprints with randomised lexicons.

The lexicon holds the terms whose document frequency lies in a band: neither the common ones nor the rare ones. A
fingerprint is a list of hashes: of the sorted distinct lexicon terms of a text, and of those terms within several
randomised subsets of the lexicon. Subsets keep a quarter, a sixteenth, ... of the terms, so that long and short texts both
have subsets in which few terms, and hence few edits, can occur. The likeness of two fingerprints is the share of
equal hashes among the subsets that hold a term of either text.

Copies count once: document frequencies are those of the distinct texts. A fingerprint holds two lists of hashes, over the
lexicon terms and over all terms of the text, within the same subsets. A text with fewer than ``LEAST_TERMS`` lexicon terms
(one of a large group of near copies, whose terms are all common, or a short one) has no hashes in the first list, and it
and the texts it is compared with are judged by the second. So any two published fingerprints can be compared.

The band is relative to the number of distinct texts, which bounds the lexicon: at most (mean distinct terms of a document)
/ (lower bound) terms, whatever the corpus size. It is kept as 64-bit term codes, 8 bytes each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, mix64, out_batch, prefix_hash, small, span_hashes, Stages, utf8

# Lexicon: terms in this share of the distinct texts (lower and upper bound).
BAND = (0.002, 0.2)
# Randomised lexicons: how many, and the share of the terms that each keeps.
SUBSETS = tuple(rate for rate, times in ((1 / 4, 4), (1 / 16, 8), (1 / 64, 16), (1 / 256, 24)) for _ in range(times))
# A rate needs so many subsets with a term of either text to be judged by.
LEAST_SUBSETS = 4
# A text with fewer lexicon terms is compared over all its terms.
LEAST_TERMS = 16
# Terms whose subsets are found at a time.
CHUNK_TERMS = 1 << 16
ROWS_PER_RANGE = 2048
MOST_RANGES = 100_000
EMPTY = "-" * 8

# Letters, digits and all bytes from 0x80 up are term characters; capitals become small.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def term_codes(text: bytes) -> np.ndarray:
    """Sorted 64-bit codes of the distinct terms of a whole text."""
    words = text.translate(_TERMS).split()
    if not words:
        return np.empty(0, np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    data = b"".join(words)
    return np.unique(span_hashes(prefix_hash(data), np.concatenate(([0], ends[:-1])), ends))


def lexicon(docs: DataFrame, stages: Stages, band: tuple[float, float] = BAND) -> np.ndarray:
    """Sorted codes of the terms whose document frequency lies in ``band``, counted over the distinct texts."""
    schema = pa.schema([("code", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = rows = 0

        def flush() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return out_batch(schema, [codes.view(np.int64), n])

        for batch in small(batches):
            rows += batch.num_rows
            for text in utf8(batch, "text"):
                held.append(term_codes(text))
                size += len(held[-1])
                if size >= 4_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
        yield out_batch(schema, [[None], [rows]])  # the null code counts the documents

    # Only texts that repeat are dealt out, one of each from a task; all others are counted where they are read.
    hashed = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumns(
        {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    repeated = stages.put(hashed.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2"), "repeated")
    repeated = broadcast_if_small(repeated, 16)
    once = hashed.join(repeated, ["h1", "h2"], "left_anti").select("text").unionByName(
        hashed.join(repeated, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]).select("text"))
    counted = once.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    terms = stages.put(counted, "terms")
    total = terms.where("code IS NULL").agg(F.sum("n").alias("n")).first()["n"] or 0
    kept = terms.where(F.col("code").isNotNull() & F.col("n").between(band[0] * total, band[1] * total))
    codes = kept.select("code").toArrow().column(0).to_numpy()
    stages.drop("terms", "repeated")
    return np.sort(codes.view(np.uint64))


class Fingerprints:
    def __init__(self, codes: np.ndarray, subsets: tuple[float, ...] = SUBSETS, seed: int = 1):
        import xxhash

        self.digest: Callable[[bytes], str] = xxhash.xxh32_hexdigest
        # a subset has the terms whose byte for it, of some seeded mixes of the term code, is below its share of 256
        self.below = np.array([round(256 * rate) for rate in subsets], dtype=np.uint16)
        if any(below != 256 * rate or not 1 <= below <= 256 for below, rate in zip(self.below.tolist(), subsets)):
            raise ValueError("a subset keeps a multiple of 1/256 of the terms")
        self.seeds = mix64(np.arange(1, len(subsets) // 8 + 2, dtype=np.uint64) + np.uint64(seed << 32))
        self.codes, self.member = codes, self._members(codes)

    def _members(self, codes: np.ndarray) -> np.ndarray:
        """For each term and subset, whether the subset has the term: a function of its code, whatever the lexicon."""
        member = np.empty((len(codes), len(self.below)), dtype=bool)
        for k in range(0, len(codes), CHUNK_TERMS):
            mixed = mix64(codes[k:k + CHUNK_TERMS, None] ^ self.seeds)
            member[k:k + CHUNK_TERMS] = mixed.astype("<u8").view(np.uint8)[:, :len(self.below)] < self.below
        return member

    def _hashes(self, own: np.ndarray, member: np.ndarray) -> str:
        return self.digest(own.tobytes()) + "".join(
            self.digest(own[member[:, k]].tobytes()) if some else EMPTY for k, some in enumerate(member.any(axis=0)))

    def of(self, text: bytes) -> str:
        """The hashes, eight hexadecimal digits each: over the lexicon terms, then over all terms of the text.

        A subset without terms of the text has none; a text with fewer than ``LEAST_TERMS`` lexicon terms has none
        in the first list.
        """
        terms = term_codes(text)
        at = np.searchsorted(self.codes, terms)
        at = at[self.codes[np.minimum(at, len(self.codes) - 1)] == terms] if len(self.codes) else at[:0]
        known = EMPTY * (1 + len(self.below)) if len(at) < LEAST_TERMS else self._hashes(self.codes[at], self.member[at])
        return known + self._hashes(terms, self._members(terms))


def likeness(a: str, b: str, subsets: tuple[float, ...] = SUBSETS) -> float:
    """Share of equal hashes among the subsets that hold a term of either text, at the rate where it is highest.

    Over the lexicon terms where both texts have enough of them, else over all terms. In dense subsets every text
    differs after few edits; sparse ones tell how much two long texts share.
    """
    size = 8 * (1 + len(subsets))
    x, y = (a[:size], b[:size]) if EMPTY not in (a[:8], b[:8]) else (a[size:], b[size:])
    if x == y:
        return 1.0
    told: dict[float, list[int]] = {}
    for k, rate in enumerate(subsets, 1):
        p, q = x[8 * k:8 * k + 8], y[8 * k:8 * k + 8]
        if p != EMPTY or q != EMPTY:
            own = told.setdefault(rate, [0, 0])
            own[0] += p == q
            own[1] += 1
    return max((same / n for same, n in told.values() if n >= LEAST_SUBSETS), default=0.0)


def edited_text(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by as many first ones of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def in_ranges(docs: DataFrame, rows_per_range: int) -> DataFrame:
    """``docs`` in id order by ranges of about ``rows_per_range`` rows, each with the first row of the next range.

    The ranges start at ids that occur (quantiles of the ids), so the first row of a range is known without a look
    at its rows: it is sent to the range before as well (``extra``; the first row of all to the last range). The texts
    are shuffled once.
    """
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    keyed = docs.withColumn("key", key)
    count, low = keyed.agg(F.count("*"), F.min("key")).first()
    ranges = min(MOST_RANGES, max(1, math.ceil(count / rows_per_range)))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = keyed.agg(F.percentile_approx("key", shares, max(10_000, 20 * ranges))).first()[0] if shares else []
    starts = np.unique(np.array([low if low is not None else 0, *(cuts or [])], dtype=np.int64))

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, keys.to_numpy(), side="right") - 1).astype("int32")

    @F.pandas_udf("boolean")
    def starts_range(keys: pd.Series) -> pd.Series:
        return pd.Series(np.isin(keys.to_numpy(), starts))

    last = len(starts) - 1
    before = F.when(F.col("range") == 0, F.lit(last)).otherwise(F.col("range") - 1)
    placed = keyed.withColumn("range", range_of("key")).withColumn("tie", F.xxhash64("text"))
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("extra"))
    copy = F.struct(before.cast("int").alias("range"), F.lit(True).alias("extra"))
    sent = placed.withColumn("to", F.explode(F.when(starts_range("key"), F.array(own, copy)).otherwise(F.array(own))))
    # one range per partition: hashing the range numbers would put several into one and none into another
    return sent.select("to.range", "to.extra", "key", "tie", "doc_id", "text").repartitionById(
        len(starts), F.col("range")).sortWithinPartitions("range", "extra", "key", "tie", "text")


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                     ("near_next", pa.float64())])


def fingerprint(docs: DataFrame, codes: np.ndarray, *, subsets: tuple[float, ...] = SUBSETS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row by a given lexicon; null texts count as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(codes, subsets)
        for batch in small(batches):
            yield out_batch(schema, [batch.column(0), [prints.of(x) for x in utf8(batch, "text")]])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(run, "doc_id long, fingerprint string")


def compare_edits(docs: DataFrame, *, band: tuple[float, float] = BAND, subsets: tuple[float, ...] = SUBSETS,
                  id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that of the next document.

    The next document is the one with the next id (after the last: the first). Null texts count as empty; null ids
    come first; rows that repeat an id follow each other in a fixed order of their texts; a table of one row has
    itself as the next; an empty table gives no rows; other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    codes = lexicon(source, Stages(docs.sparkSession, "imatch"), band)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(codes, subsets)
        held = None  # (range, doc_id, text, fingerprint), waiting for its next document

        def result(row: tuple, text: str, own: str) -> tuple:
            edited = edited_text(row[2], text).encode()
            changed = prints.of(edited)
            return (row[1], len(row[2]), sha256(edited).hexdigest(), row[3], changed,
                    likeness(row[3], changed, subsets), likeness(row[3], own, subsets))

        for batch in small(batches):
            out = []
            for at, extra, doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
                if extra and held is None:
                    continue  # a further row with the first id of the next range
                own = prints.of(text.encode())
                if held is not None:
                    out.append(result(held, text, own))
                held = None if extra else (at, doc_id, text, own)
            if out:
                yield out_batch(_RESULT, list(zip(*out)))
        if held is not None:
            raise RuntimeError("a range lacks the row that follows it")

    rows = in_ranges(source, rows_per_range).select("range", "extra", "doc_id", "text")
    return rows.mapInArrow(run, RESULT)
