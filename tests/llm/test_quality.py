"""The discriminant against numpy, and held-out accuracy on the given tables."""

import zlib

import numpy as np
import pytest

from tests.conftest import SF01
from tidemark.llm import quality, queries


def test_scores_are_normal_log_densities():
    rnd = np.random.default_rng(2)
    x = [rnd.normal(0, 1, (300, 3)) @ np.array([[1, .3, 0], [0, 1, 0], [0, 0, 2]]), rnd.normal(1, 0.5, (200, 3))]
    moments = {c: np.hstack([np.ones((len(v), 1)), v]).T @ np.hstack([np.ones((len(v), 1)), v]) for c, v in enumerate(x)}
    model = quality.discriminant(moments, to_pooled=0.0, to_identity=0.0)
    z = np.vstack(x)
    want = []
    for v in x:
        mean, cov = v.mean(axis=0), np.cov(v.T, bias=True)
        d = z - mean
        want.append(-0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.log(np.linalg.det(cov))))
    logit = want[1] - want[0] + np.log(200 / 300)
    assert model.score(z) == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)


def test_constant_statistics_and_one_class():
    z = np.ones((5, 4))
    assert quality.discriminant({0: z.T @ z}) == pytest.approx(1 / 7)
    assert quality.discriminant({1: z.T @ z}) == pytest.approx(6 / 7)
    assert quality.discriminant({}) == 0.5
    both = quality.discriminant({0: z.T @ z, 1: z.T @ z})
    assert np.isfinite(both.score(np.ones((1, 3)))).all()


def test_held_out_accuracy_and_independence_of_other_columns(workers):
    docs = workers.read.parquet(f"{SF01}/documents.parquet")
    labels = workers.read.parquet(f"{SF01}/labels.parquet")
    out = quality.classify(docs, labels).toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    assert ((out.score >= 0.7) == (out.predicted == 1)).all() and out.score.between(0, 1).all()
    known = labels.toPandas().merge(out, on="doc_id")
    fresh = known[known.held_out]
    assert (fresh.predicted == fresh.quality).mean() > 0.95
    # held-out labels, language and source change nothing
    from pyspark.sql import functions as F
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(
        F.col("quality")))
    again = quality.classify(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None)), other).toPandas()
    merged = out.merge(again, on="doc_id")
    assert np.allclose(merged.score_x, merged.score_y, atol=1e-6)


def test_awkward_rows(messy, no_rows, workers):
    labels = workers.createDataFrame([(k, k % 2, "t") for k in range(30)] + [(None, 1, "t"), (3, None, "t"), (4, 7, "t"), (9999, 1, "t")],
                                     "doc_id long, quality int, text string")
    out = quality.classify(messy, labels).collect()
    assert len(out) == messy.count() and all(0 <= r.score <= 1 for r in out)
    assert [r.held_out for r in out if r.doc_id is None] == [False, False]
    assert quality.classify(no_rows, labels).collect() == []
    constant = quality.classify(messy, labels.where("quality = 1")).collect()
    assert len({r.score for r in constant}) == 1
    none = quality.classify(messy, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_accepted_rows(messy, workers):
    labels = workers.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, quality int")
    kept = quality.accepted(messy, labels)
    want = {(r.doc_id, r.text_hash) for r in quality.classify(messy, labels).collect() if r.predicted}
    from pyspark.sql import functions as F
    got = {(r.doc_id, r.h) for r in kept.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    assert got == want and kept.columns == messy.columns


def test_query(workers):
    out = queries.queries()["op5_quality"](workers, SF01)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
