"""Exact top-k by inner product over a bit-sliced index.

Index: rows in blocks of at most ``block_rows``; per block and dimension the integer components, shifted to be
non-negative, are cut into bit slices (one bitmap over the block's rows per bit).

Query: ``score = sum_d q_d * x_d``. The high slices of every dimension are added with bitmap arithmetic: each set
bit of ``|q_d|`` contributes the slices at its weight (complemented for a negative ``q_d``), and carry-save adders
(three bitmaps in, a sum and a carry out) reduce every weight to one slice. The result is the bit-sliced quantised
score of all rows of the block. The k best of it are selected from the most significant slice downward. The low
slices that were left out can change a score by a known amount only, so every row within that amount of the k-th
quantised score is a boundary row; its exact integer score is computed from all its slices, and ties go to the
smaller id. The result is exact.

Queries meet all rows block by block; a query block and an index block are one unit of work, so no task depends on
the size of the table. Per query and block k rows remain, which one window ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Stages, broadcast_if_small, out_batch

SCALE = 256
BLOCK_ROWS = 16384
QUERY_ROWS = 256
# Low slices left out of the bitmap sum. Fewer additions against more boundary rows.
LOW_SLICES = 2

INDEX = "dim int, block string, rows int, offsets binary, widths binary, ids binary, slices binary"
_INDEX = pa.schema([("dim", pa.int32()), ("block", pa.string()), ("rows", pa.int32()), ("offsets", pa.binary()),
                    ("widths", pa.binary()), ("ids", pa.binary()), ("slices", pa.binary())])
TOP = "query_id long, vec_id long, score long"
_TOP = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, x``: integer components ``floor(scale * component)``; unusable vectors and null ids go."""
    x = F.col("x")
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("x")).where(
        F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)
        & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))).select(
        "vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("x"))


def slice_block(ids: np.ndarray, x: np.ndarray) -> tuple:
    """Offsets, widths, ids and packed slices of a block (rows x dimensions, int64)."""
    low = x.min(axis=0)
    shifted = (x - low).astype(np.uint64)
    widths = np.array([int(v).bit_length() for v in shifted.max(axis=0)], dtype=np.int32)
    pad = -len(x) % 64
    columns = np.pad(shifted, ((0, pad), (0, 0))).T
    bitmaps = [np.packbits((columns[d] >> np.uint64(b)).astype(np.uint8) & 1, bitorder="little")
               for d in range(x.shape[1]) for b in range(widths[d])]
    packed = np.concatenate(bitmaps) if bitmaps else np.empty(0, np.uint8)
    return low.astype("<i8").tobytes(), widths.tobytes(), ids.astype("<i8").tobytes(), packed.tobytes()


def build_index(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per block; blocks are cut from the partitions as they are read, without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, count = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal count
            ids, x = (np.concatenate(c) for c in zip(*held.pop(dim)))
            count += 1
            parts = slice_block(ids, x)
            return out_batch(_INDEX, [[v] for v in (dim, f"{task}-{count}", len(ids), *parts)])

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                x = flat[starts[at][:, None] + np.arange(dim)]
                while len(at):
                    own = held.setdefault(int(dim), [])
                    room = block_rows - sum(len(i) for i, _ in own)
                    own.append((ids[at[:room]], x[:room]))
                    at, x = at[room:], x[room:]
                    if sum(len(i) for i, _ in own) >= block_rows:
                        yield flush(int(dim))
        for dim in list(held):
            yield flush(dim)

    return rows.mapInArrow(run, INDEX)


class SlicedBlock:
    """A block of the index, ready for queries."""

    def __init__(self, rows: int, offsets: bytes, widths: bytes, ids: bytes, slices: bytes, low_slices: int):
        self.rows = rows
        self.offsets = np.frombuffer(offsets, "<i8")
        self.widths = np.frombuffer(widths, np.int32)
        self.ids = np.frombuffer(ids, "<i8")
        words = (rows + 63) // 64
        self.slices = np.frombuffer(slices, np.uint64).reshape(-1, words)
        self.first = np.concatenate(([0], np.cumsum(self.widths)))
        self.valid = np.full(words, np.uint64(2**64 - 1))
        if rows % 64:
            self.valid[-1] = np.uint64((1 << rows % 64) - 1)
        self.inverse = ~self.slices & self.valid
        # a dimension keeps at least its top slice in the sum
        self.low = np.minimum(low_slices, np.maximum(self.widths - 1, 0))
        self.spread = (1 << self.low.astype(np.int64)) - 1
        self.top = (1 << self.widths.astype(np.int64)) - 1
        self.exact = self._values()

    def _values(self) -> np.ndarray:
        """The shifted components again (rows x dimensions), from all slices."""
        out = np.zeros((len(self.widths), self.rows), dtype=np.int64)
        for d, width in enumerate(self.widths):
            for b in range(width):
                bits = np.unpackbits(self.slices[self.first[d] + b].view(np.uint8), bitorder="little")[:self.rows]
                out[d] |= bits.astype(np.int64) << b
        return out.T

    def quantised_sum(self, q: np.ndarray) -> list[np.ndarray]:
        """Slices (least significant first) of ``sum |q_d| * high part``, a negative ``q_d`` with the complement."""
        weights: list[list[np.ndarray]] = []
        for d in np.flatnonzero((q != 0) & (self.widths > 0)):
            source = self.slices if q[d] > 0 else self.inverse
            own = [source[self.first[d] + b] for b in range(self.low[d], self.widths[d])]
            factor, shift = abs(int(q[d])), 0
            while factor:
                if factor & 1:
                    for b, bitmap in enumerate(own, start=shift + int(self.low[d])):
                        while len(weights) <= b:
                            weights.append([])
                        weights[b].append(bitmap)
                factor >>= 1
                shift += 1
        out, w = [], 0
        while w < len(weights):
            column = weights[w]
            if len(column) > 1 and w + 1 == len(weights):
                weights.append([])
            while len(column) > 2:  # full adder
                a, b, c = column.pop(), column.pop(), column.pop()
                half = a ^ b
                weights[w + 1].append((a & b) | (half & c))
                column.insert(0, half ^ c)
            if len(column) == 2:  # half adder
                a, b = column.pop(), column.pop()
                weights[w + 1].append(a & b)
                column.append(a ^ b)
            out.append(column[0] if column else np.zeros_like(self.valid))
            w += 1
        return out

    def top_rows(self, sliced: list[np.ndarray], k: int) -> tuple[np.ndarray, int]:
        """The k best rows (with all ties) by the sliced score, and the k-th score, from the top slice downward."""
        sure, open_, found, value = np.zeros_like(self.valid), self.valid, 0, 0
        for s in range(len(sliced) - 1, -1, -1):
            ones = open_ & sliced[s]
            count = int(np.bitwise_count(ones).sum())
            if found + count >= k:
                open_, value = ones, value | 1 << s
            else:
                sure, open_, found = sure | ones, open_ & ~sliced[s], found + count
        return sure | open_, value

    def at_least(self, sliced: list[np.ndarray], bound: int) -> np.ndarray:
        """Bitmap of the rows whose sliced score is ``bound`` or more."""
        if bound <= 0:
            return self.valid
        if bound >> len(sliced):
            return np.zeros_like(self.valid)
        above, equal = np.zeros_like(self.valid), self.valid
        for s in range(len(sliced) - 1, -1, -1):
            if bound >> s & 1:
                equal = equal & sliced[s]
            else:
                above, equal = above | (equal & sliced[s]), equal & ~sliced[s]
        return above | equal

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows other than those with the query's id."""
        own = int((self.ids == query_id).sum())
        sliced = self.quantised_sum(q)
        _, kth = self.top_rows(sliced, min(k + own, self.rows))
        # the part left out lies between 0 and sum |q_d| * spread_d for every row
        margin = int((np.abs(q) * self.spread).sum())
        rows = np.flatnonzero(np.unpackbits(self.at_least(sliced, kth - margin).view(np.uint8),
                                            bitorder="little")[:self.rows])
        rows = rows[self.ids[rows] != query_id]
        scores = (self.exact[rows] + self.offsets) @ q
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][best], scores[best]


def search_blocks(k: int, low_slices: int):
    """Arrow batches of (query block, index block) pairs to the k best rows of each query in the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, block = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != name:
                    block = SlicedBlock(row["rows"], row["offsets"], row["widths"], row["ids"], row["slices"], low_slices)
                    name = row["block"]
                ids = np.frombuffer(row["query_ids"], "<i8")
                queries = np.frombuffer(row["queries"], "<i8").reshape(len(ids), -1)
                reach = np.abs(block.offsets).astype(object) + block.top
                if int((reach * int(np.abs(queries).max(initial=0))).sum()) >= 1 << 62:
                    raise OverflowError("components too large: a score would not fit 64 bits")
                found = [block.search(int(i), q, k) for i, q in zip(ids, queries)]
                yield out_batch(_TOP, [np.repeat(ids, [len(f[0]) for f in found]),
                                       np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])])

    return run


def query_blocks(queries: DataFrame, query_rows: int) -> DataFrame:
    """``dim, query_block, query_ids, queries``: distinct query ids in blocks, cut from the partitions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, count = TaskContext.get().partitionId(), 0
        schema = pa.schema([("dim", pa.int32()), ("query_block", pa.string()), ("query_ids", pa.binary()),
                            ("queries", pa.binary())])
        held: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(len(row["x"]), []).append((row["vec_id"], row["x"]))
            for dim in [d for d, v in held.items() if len(v) >= query_rows]:
                rows = held.pop(dim)
                for a in range(0, len(rows), query_rows):
                    count += 1
                    yield _query_batch(schema, dim, f"{task}-{count}", rows[a:a + query_rows])
        for dim, rows in held.items():
            count += 1
            yield _query_batch(schema, dim, f"{task}-{count}", rows)

    return queries.mapInArrow(run, "dim int, query_block string, query_ids binary, queries binary")


def _query_batch(schema: pa.Schema, dim: int, name: str, rows: list) -> pa.RecordBatch:
    ids, x = np.array([r[0] for r in rows], "<i8"), np.array([r[1] for r in rows], "<i8")
    return out_batch(schema, [[dim], [name], [ids.tobytes()], [x.tobytes()]])


def top_k(vectors: DataFrame, is_query, *, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
          low_slices: int = LOW_SLICES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of highest integer inner product for every query row.

    ``is_query`` is a condition over ``vec_id``. Null ids, and vectors that are null, empty or hold a null or
    non-finite component, take no part; vectors of another length than the query's are no candidates. Rows that
    repeat an id are candidates each, but never of the query with that id; a repeated query id counts once, with its
    smallest vector. An empty table gives no rows. Other columns are not read.
    """
    stages = Stages(vectors.sparkSession, "bitsliced")
    rows = quantised(vectors, id_col, vector_col, scale)
    index = stages.put(build_index(rows, block_rows), "index")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("x").alias("x"))
    queries = stages.put(query_blocks(asked, query_rows), "queries")
    # each pair of blocks is a unit of its own, keyed by both names; the name lists are 1/block_rows of the rows
    index_names, query_names = index.select("dim", "block"), queries.select("dim", "query_block")
    left = index.join(broadcast_if_small(query_names, 64), "dim")
    right = queries.join(broadcast_if_small(index_names, 64), "dim")
    work = left.join(right, ["dim", "block", "query_block"])
    best = work.mapInArrow(search_blocks(k, low_slices), TOP)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
