"""Quality classifier: regularised quadratic discriminant over document statistics.

Every text is reduced to a fixed vector of transformed statistics (logs of lengths and shares). Each class is a
normal distribution over them; its covariance is shrunk towards the pooled covariance and towards a scaled identity.
The score is the logistic of the difference of the two log densities plus the log prior ratio; densities come
from Mahalanobis distances with Cholesky factors that are computed once and kept in the model.

The fit needs only sums (counts, sums and cross products per class), which every task forms over its own rows and
one small aggregation adds up, so it uses all labelled rows at any size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, out_batch, small, Stages, utf8

# Shrinkage of a class covariance towards the pooled one, and of the result towards a scaled identity.
TO_POOLED = 0.05
TO_IDENTITY = 0.005
THRESHOLD = 0.7
# Classes of bytes; everything from 0x80 up counts as letters.
_LOWER = np.arange(ord("a"), ord("z") + 1)
_UPPER = np.arange(ord("A"), ord("Z") + 1)
_DIGIT = np.arange(ord("0"), ord("9") + 1)
_SPACE = np.array([9, 10, 11, 12, 13, 32])
_SENTENCE = np.frombuffer(b".,;:?'\"-()", np.uint8)
_HIGH = np.arange(128, 256)

STATISTICS = ("bytes", "words", "lines", "word length", "line length", "capitals", "digits", "sentence marks",
              "other marks", "commonest mark", "control bytes", "distinct words", "distinct lines", "short words",
              "marked words", "byte entropy", "compressed size", "repeated neighbours")


_MARK = np.zeros(256, np.uint8)
_MARK[33:127] = 1
for _x in (_LOWER, _UPPER, _DIGIT, _SENTENCE):
    _MARK[_x] = 0
_BLANK = np.zeros(256, np.uint8)
_BLANK[_SPACE] = 1
# Units of an ordinary text that every share is smoothed with, so that short texts stay near ordinary values.
SMOOTHING = 30


def _share(part: int, whole: int, ordinary: float) -> float:
    return np.log((part + SMOOTHING * ordinary) / (whole + SMOOTHING) + 0.01)


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of a whole text, in the order of ``STATISTICS``; an empty text gives ordinary shares."""
    raw = np.frombuffer(text, np.uint8)
    counts, n = np.bincount(raw, minlength=256), len(text)
    space, lower, upper, high = (int(counts[x].sum()) for x in (_SPACE, _LOWER, _UPPER, _HIGH))
    marks, is_mark = counts * _MARK, _MARK[raw]
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    w, rows = len(words), len(lines)
    seen = counts[counts > 0] / max(1, n)
    marked = int((is_mark[:-1] & _BLANK[raw[1:]]).sum() + is_mark[-1:].sum())
    return [
        np.log1p(n), np.log1p(w), np.log1p(rows),
        np.log((n - space + 5 * SMOOTHING) / (w + SMOOTHING)), np.log((n + 150 * 3) / (rows + 3)),
        _share(upper, lower + upper + high, 0.03), _share(int(counts[_DIGIT].sum()), n, 0.005),
        _share(int(counts[_SENTENCE].sum()), n, 0.03), _share(int(marks.sum()), n, 0.001),
        _share(int(marks.max()), n, 0.001), _share(int(counts[:9].sum() + counts[14:32].sum()), n, 0.0),
        _share(len(set(words)), w, 0.8), _share(len(set(lines)), rows, 1.0),
        _share(sum(map((3).__ge__, map(len, words))), w, 0.4), _share(marked, w, 0.01),
        (float(-(seen * np.log(seen)).sum()) * n + 2.9 * 200) / (n + 200),
        np.log((len(zlib.compress(text, 1)) + 0.45 * 200) / (n + 200)),
        _share(sum(map(bytes.__eq__, words, words[1:])), w, 0.01),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, x``: the statistics of every row (null text: empty)."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            yield out_batch(schema, [batch.column(0), batch.column(1), [statistics(x) for x in utf8(batch, "text")]])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
                       ).mapInArrow(run, "doc_id long, text_hash long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Per class: mean, inverse Cholesky factor of the shrunk covariance, log determinant; and the log prior ratio."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    log_dets: tuple[float, float]
    log_prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        density = [-0.5 * (np.square((z - m) @ f.T).sum(axis=1) + d)
                   for m, f, d in zip(self.means, self.factors, self.log_dets)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_prior, -500, 500)))


def discriminant(moments: dict[int, np.ndarray], to_pooled: float = TO_POOLED,
                 to_identity: float = TO_IDENTITY) -> Discriminant | float:
    """The model from per-class sums of ``z zT`` with ``z = (1, x)``.

    A class without rows leaves nothing to compare: the model is then the constant (n1 + 1) / (n + 2).
    """
    n = [moments[c][0, 0] if c in moments else 0.0 for c in (0, 1)]
    if min(n) == 0:
        return float((n[1] + 1) / (n[0] + n[1] + 2))
    both = moments[0] + moments[1]
    centre = both[0, 1:] / both[0, 0]
    variance = np.diag(both)[1:] / both[0, 0] - centre**2
    scale = np.where(variance > 1e-9, np.sqrt(np.maximum(variance, 1e-9)), 1.0)
    means, scatter = [], []
    for c in (0, 1):
        mean = moments[c][0, 1:] / n[c]
        cov = moments[c][1:, 1:] / n[c] - np.outer(mean, mean)
        means.append((mean - centre) / scale)
        scatter.append(cov / np.outer(scale, scale))
    pooled = (n[0] * scatter[0] + n[1] * scatter[1]) / sum(n)
    factors, dets = [], []
    for cov in scatter:
        cov = (1 - to_pooled) * cov + to_pooled * pooled
        size = max(np.trace(cov) / len(cov), 1e-6)
        cov = (1 - to_identity) * cov + to_identity * size * np.eye(len(cov))
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        dets.append(float(2 * np.log(np.diag(lower)).sum()))
    return Discriminant(centre, scale, tuple(means), tuple(factors), tuple(dets), float(np.log(n[1] / n[0])))


def fit(labelled: DataFrame, **shrinkage) -> Discriminant | float:
    """Fit on rows ``x, y`` (y 0 or 1; other values and nulls are left out). The driver gets sums only."""
    schema = pa.schema([("y", pa.int32()), ("cell", pa.int32()), ("v", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in small(batches):
            y = batch.column(1).to_numpy(zero_copy_only=False)
            x = np.array(batch.column(0).to_pylist()).reshape(len(y), -1)
            z = np.hstack([np.ones((len(x), 1)), x])
            for c in np.unique(y):
                own = z[y == c]
                sums[int(c)] = sums.get(int(c), 0) + own.T @ own
        for c, m in sums.items():
            yield out_batch(schema, [np.full(m.size, c), np.arange(m.size), m.ravel()])

    used = labelled.select("x", F.col("y").cast("int")).where("y IN (0, 1)")
    rows = used.mapInArrow(run, "y int, cell int, v double").groupBy("y", "cell").agg(F.sum("v").alias("v")).collect()
    size = int(np.sqrt(max((r["cell"] for r in rows), default=0) + 1))
    moments: dict[int, np.ndarray] = {}
    for r in rows:
        moments.setdefault(r["y"], np.zeros((size, size))).flat[r["cell"]] = r["v"]
    return discriminant(moments, **shrinkage)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text, modulo 4, is 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score(rows: DataFrame, model: Discriminant | float) -> DataFrame:
    """``doc_id, text_hash, score`` for rows ``doc_id, text_hash, x``."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            if isinstance(model, float) or not batch.num_rows:
                found = np.full(batch.num_rows, model if isinstance(model, float) else 0.0)
            else:
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                found = model.score(x)
            yield out_batch(schema, [batch.column(0), batch.column(1), found])

    return rows.select("doc_id", "text_hash", "x").mapInArrow(run, "doc_id long, text_hash long, score double")


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = THRESHOLD, **shrinkage) -> DataFrame:
    """``doc_id, text_hash, held_out, score, predicted`` for every row of ``docs``.

    The model is fitted on all labelled rows that are not held out. Only the text enters a score. Null and empty
    texts are scored like any other; labels that are null or neither 0 nor 1 and labels of unknown ids count
    nothing; repeated rows are scored each; without labels of both classes the score is one constant.
    """
    stages = Stages(docs.sparkSession, "quality")
    rows = stages.put(features(docs, id_col, text_col), "features")
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("y"))
    model = fit(rows.where(~held_out(F.col("doc_id"))).join(known, "doc_id"), **shrinkage)
    return score(rows, model).select("doc_id", "text_hash", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts 1 for, with all their columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    stages = Stages(docs.sparkSession, "accepted")
    rejected = stages.put(classify(docs, labels, **options).where("predicted = 0").select(
        F.col("doc_id").alias("_rejected_id"), F.col("text_hash").alias("_rejected_hash")).distinct(), "rejected")
    same = (F.col(id_col).cast("long").eqNullSafe(F.col("_rejected_id"))
            & (F.xxhash64(F.col(text_col).cast("string")) == F.col("_rejected_hash")))
    return docs.join(broadcast_if_small(rejected, 16), same, "left_anti")
