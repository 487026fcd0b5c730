"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, free_shuffles

# Largest side that is broadcast, by its measured bytes. A larger side goes through a shuffle join.
MAX_BROADCAST_BYTES = 16 * 1024 * 1024


class Stages:
    """Tables of one operator run, written under the shared folder in ``spark.checkpoint.dir``.

    A stage cuts lineage and outlives lost executors. ``drop`` removes tables that later steps no longer
    read; the tables behind the returned DataFrame stay until ``drop_stages`` or the cluster's own clean-up.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        base = ensure_checkpoint_dir(spark).rstrip("/")
        self.root = f"{base}/tidemark-stages/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str, partition_by: list[str] | None = None, tasks: int | None = None) -> DataFrame:
        """Write and read back; with ``tasks`` at most that many write (for tables known to be small).

        A task writes one file per folder whatever the session's record limit, so (task number, row in file) is a place.
        """
        writer = (df if tasks is None else df.coalesce(tasks)).write.mode("overwrite").option(
            "compression", "zstd").option("maxRecordsPerFile", 0)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        self.names.add(name)
        free_shuffles(self.spark)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def keep(self, *names: str) -> None:
        """Remove all tables but those that the returned frames still read."""
        self.drop(*(self.names - set(names)))

    def drop(self, *names: str) -> None:
        self.names -= set(names)
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a checkout on a shared path).

    On a cluster the package is installed or shipped with ``--py-files``; the extra path then does nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def broadcast_if_small(df: DataFrame, row_bytes: Column | int, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the measured bytes of a *staged* table are within ``limit``.

    ``row_bytes`` is the size of one row (a number, or a column for rows of varying size). A larger side is
    returned without a hint, so Spark joins by shuffle and splits hot keys.
    """
    size = df.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes).alias("b")).first()["b"] or 0
    return F.broadcast(df) if size <= limit else df


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a worker turns only some rows at a time into Python objects."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def out_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def by_bytes(texts: list[bytes], size: int) -> Iterator[slice]:
    """Slices of whole texts of about ``size`` bytes together; a longer text stands alone."""
    start, held = 0, 0
    for k, x in enumerate(texts):
        if held and held + len(x) > size:
            yield slice(start, k)
            start, held = k, 0
        held += len(x)
    if start < len(texts):
        yield slice(start, len(texts))


# ASCII white space, the bytes that end a word.
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True

# ---- hashes over bytes --------------------------------------------------------------------

# Odd multiplier of the rolling hash and constants of the 64-bit finaliser (splitmix64; fixed values).
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_BYTE_CODES = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * BASE)
_powers = {BASE: np.ones(1, dtype=np.uint64), BASE_INVERSE: np.ones(1, dtype=np.uint64)}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for ``i < n``; the table grows with the longest text seen."""
    have = _powers[base]
    if len(have) < n:
        have = np.full(max(n, 2 * len(have)), base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = np.multiply.accumulate(have)
    return _powers[base][:n]


def prefix_hash(data: bytes) -> np.ndarray:
    """``P`` with ``P[j] - P[i]`` = sum of ``code(byte k) * BASE**k`` over ``i <= k < j``."""
    raw = np.frombuffer(data, dtype=np.uint8)
    out = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[raw] * powers(BASE, len(raw)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, equal for equal bytes wherever they stand."""
    span = (prefix[end] - prefix[start]) * powers(BASE_INVERSE, len(prefix))[start]
    return mix64(span + (end - start).astype(np.uint64))
