"""A history table that is merged into with Spark's own writers: catalog tables, dynamic partition overwrite, a view.

The rows lie in the catalog table ``<name>_base``, partitioned by a hash bucket of the item keys, so all versions of an
item share a partition. Readers, plain SQL included, use the view ``<name>``. A merge

1. reads only the buckets its source touches and writes their new rows to the table ``<name>_delta``;
2. switches the view to the base without those buckets and the delta: from here on readers see the whole merge;
3. overwrites just those partitions of the base from the delta, and switches the view back.

A merge that dies before 2 has changed nothing; one that dies after it is complete for readers, and the next one finishes
step 3 first. A query that was planned on the base before a merge and still runs in its step 3 can fail for missing
files, and is then run again; it never mixes old and new rows. One writer at a time; a catalog that outlives the session
(a metastore) is needed for the table to do so.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.common import MAX_BROADCAST_BYTES
from tidemark.operators.merge import merge_range_update, merge_upsert
from tidemark.sources.tables import stage_table

BUCKET = "_bucket"


class MergeTable:
    """``name`` is a view of the catalog; its rows are hash-partitioned by ``bucket_keys``.

    The source of a merge is staged once, so every part of the merge sees the same rows. A source of at most
    ``broadcast_bytes`` is broadcast, so even the touched target rows are not shuffled.
    """

    def __init__(self, name: str, bucket_keys: Sequence[str], buckets: int = 256):
        self.name, self.base, self.delta = name, f"{name}_base", f"{name}_delta"
        self.bucket_keys = list(bucket_keys)
        self.buckets = buckets

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.bucket_keys]), F.lit(self.buckets)).cast("int")

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, self.bucket_of())

    def _columns(self, spark: SparkSession) -> list[str]:
        return [x for x in spark.table(self.base).columns if x != BUCKET]

    def _show(self, spark: SparkSession, touched: Sequence[int] = ()) -> None:
        """Point the view to the base, with the delta in place of the touched buckets."""
        columns = ", ".join(f"`{x}`" for x in self._columns(spark))
        rows = f"SELECT {columns} FROM {self.base}"
        if touched:
            listed = ", ".join(map(str, touched))
            rows += f" WHERE {BUCKET} NOT IN ({listed}) UNION ALL SELECT {columns} FROM {self.delta}"
        spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS {rows}")

    def _pending(self, spark: SparkSession) -> bool:
        """The view reads the delta: a merge has been shown and not yet moved to the base."""
        if not spark.catalog.tableExists(self.name):
            return False
        text = spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'View Text'").first()
        return text is not None and f"FROM {self.delta}" in text["data_type"]

    def _fold(self, spark: SparkSession) -> None:
        """Overwrite the partitions of the base that the delta holds, then read the base alone."""
        # a session of its own, as the mode is a session setting and the caller's stays as it is
        writer = spark.newSession()
        writer.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        rows = writer.table(self.delta).select(*self._columns(spark), BUCKET)
        rows.write.insertInto(self.base, overwrite=True)
        spark.catalog.refreshTable(self.base)
        self._show(spark)
        spark.sql(f"DROP TABLE IF EXISTS {self.delta}")

    def create(self, df: DataFrame) -> None:
        """Start the table with exactly ``df`` and its columns, replacing any rows there were."""
        spark = df.sparkSession
        spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        self._bucketed(df).write.mode("overwrite").partitionBy(BUCKET).format("parquet").saveAsTable(self.base)
        self._show(spark)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def _merge(self, source: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        spark = source.sparkSession
        source = stage_table(source, f"merge/{self.name}/{uuid.uuid4().hex[:12]}")
        # at most `buckets` small integers cross the driver
        touched = sorted(r[0] for r in source.select(self.bucket_of().alias("b")).distinct().collect())
        if not touched:
            return
        if self._pending(spark):
            self._fold(spark)
        rows = spark.table(self.base).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = merge(rows, source)
        added = [f for f in merged.schema.fields if f.name not in rows.columns]
        spark.sql(f"DROP TABLE IF EXISTS {self.delta}")
        self._bucketed(merged).write.mode("overwrite").partitionBy(BUCKET).format("parquet").saveAsTable(self.delta)
        if added:  # NULL in the files there are
            listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {self.base} ADD COLUMNS ({listed})")
        self._show(spark, touched)
        self._fold(spark)

    def upsert(self, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None,
               insert: Sequence[str] | None = None, broadcast_bytes: int | None = MAX_BROADCAST_BYTES) -> None:
        self._merge(source, lambda target, rows: merge_upsert(
            target, rows, keys, update, insert, broadcast_bytes=broadcast_bytes))

    def range_update(self, source: DataFrame, keys: Sequence[str], at: str, start: str, end: str,
                     set_col: str, from_col: str, target_key: Sequence[str], on_multi: str = "error",
                     prefer: Sequence[str] = (), broadcast_bytes: int | None = MAX_BROADCAST_BYTES) -> None:
        self._merge(source, lambda target, rows: merge_range_update(
            target, rows, keys, at, start, end, set_col, from_col, target_key, on_multi=on_multi, prefer=prefer,
            broadcast_bytes=broadcast_bytes))
