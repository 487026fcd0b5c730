"""Bit-sliced top-k against all inner products."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import bitsliced
from tidemark.llm.bitsliced import SlicedBlock, slice_block

SCHEMA = "vec_id long, embedding array<double>, label int, block string, x string, dim int, rank int"


def brute(rows, is_query, k):
    usable = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
              if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    queries = {}
    for i, x in usable:
        if is_query(i):
            queries[i] = min(queries.get(i, x), x)
    out = set()
    for q, x in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in usable if i != q and len(y) == len(x))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "b", "x", 3, 7) for i, v in rows], SCHEMA)


def result(df, **options):
    return [tuple(r) for r in bitsliced.top_k(df, F.col("vec_id") % 5 == 0, **options).collect()]


def test_awkward_rows(workers):
    rnd = np.random.default_rng(1)
    rows = [(k, rnd.normal(0, 0.2, 8).tolist()) for k in range(150)]
    rows += [(k, rows[3][1]) for k in range(200, 230)]                                        # ties
    rows += [(300, None), (305, []), (310, [None] * 8), (315, [float("nan")] * 8), (320, [float("inf")] + [0.0] * 7)]
    rows += [(None, rows[0][1]), (330, [0.0] * 8), (335, [0.1] * 3), (336, [0.2] * 3), (5, rows[5][1]), (10, rows[11][1])]
    for options in ({}, {"block_rows": 16, "query_rows": 4}, {"low_slices": 0}, {"low_slices": 9}, {"k": 400}):
        got = result(table(workers, rows), **options)
        want = brute(rows, lambda i: i % 5 == 0, options.get("k", 5))
        assert {(q, i, s) for q, _, i, s in got} == {(q, i, s) for q, _, i, s in want}, options
        assert sorted((q, r) for q, r, _, _ in got) == sorted((q, r) for q, r, _, _ in want)


def test_empty_table(workers):
    assert result(workers.createDataFrame([], SCHEMA)) == []


def test_too_large_scores_raise(workers):
    with pytest.raises(Exception, match="64 bits"):
        result(table(workers, [(0, [1e12, 1e12]), (1, [1e12, 1.0])]))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-300, 300), min_size=4, max_size=4), min_size=1, max_size=80),
       st.lists(st.integers(-300, 300), min_size=4, max_size=4), st.integers(1, 6), st.integers(0, 10))
def test_bitmap_sums_and_selection(rows, query, k, low):
    x, q = np.array(rows, dtype=np.int64), np.array(query, dtype=np.int64)
    offsets, widths, ids, slices = slice_block(np.arange(len(x), dtype=np.int64), x)
    block = SlicedBlock(len(x), offsets, widths, ids, slices, low)
    assert (block.exact + block.offsets == x).all()
    found, scores = block.search(-1, q, k)
    want = sorted((-int(s), i) for i, s in enumerate(x @ q))[:k]
    assert [(-int(s), int(i)) for i, s in zip(found, scores)] == want


def test_registered_query_over_all_vectors(workers):
    from tests.conftest import SF001
    from tidemark.llm import queries

    rows = workers.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.floor(256 * np.array([r.embedding for r in rows], dtype=np.float64)).astype(np.int64)
    want = []
    for q in np.flatnonzero(ids % 50 == 0):
        scores = x @ x[q]
        order = [k for k in np.lexsort((ids, -scores)) if ids[k] != ids[q]][:5]
        want += [(int(ids[q]), n + 1, int(ids[k]), int(scores[k])) for n, k in enumerate(order)]
    found = queries.queries()["op3_topk"](workers, SF001).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == sorted(want)
