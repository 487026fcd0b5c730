"""Table readers and writers: catalog/parquet scans, JDBC and staging."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.common import total_bytes
from tidemark.session import ensure_checkpoint_dir, free_shuffles


# ---- scans ------------------------------------------------------------------------------

def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Catalog table by name, or a parquet directory by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.read.table(name_or_path)


def jdbc_options(url: str, dbtable: str, *, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 bounds: tuple[int, int] | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a JDBC read.

    ``numPartitions`` alone parallelises nothing: Spark splits a JDBC read only
    on ``partitionColumn`` with ``lowerBound``/``upperBound``. Without a
    partition column the read is one task, so ``num_partitions`` is then not set.
    """
    opts = {"url": url, "dbtable": dbtable, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if bounds is None or num_partitions is None:
            raise ValueError("a partitioned JDBC read needs bounds and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
                    numPartitions=str(num_partitions))
    return opts


def split_points(sample: DataFrame, column: str, parts: int) -> list:
    """At most ``parts - 1`` ascending values that cut ``column`` into ranges of about as many rows.

    For every ordered type: Spark range-partitions the (sampled) values, and the first value of each range but the lowest
    is a cut point; at most ``parts`` values reach the driver. NULLs and repeats of a value do not move a cut.
    """
    values = sample.where(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    firsts = values.repartitionByRange(parts, "v").groupBy(F.spark_partition_id()).agg(F.min("v").alias("v"))
    return sorted({r["v"] for r in firsts.collect()})[1:]


def sql_literal(value) -> str:
    """A value as an ANSI SQL literal."""
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, _dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def split_predicates(column: str, points: Sequence) -> list[str]:
    """Disjoint conditions that hold every row exactly once: the ranges between the points, NULLs in the first.

    The points ascend in the order of the database (its collation, for text).
    """
    at = [sql_literal(p) for p in points]
    if not at:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(at, at[1:])]
    return [f"({column} < {at[0]} OR {column} IS NULL)", *inner, f"{column} >= {at[-1]}"]


def read_jdbc(spark: SparkSession, url: str, dbtable: str, *, partition_column: str | None = None,
              num_partitions: int = 10, bounds: tuple[int, int] | None = None, points: Sequence | None = None,
              **conn) -> DataFrame:
    """JDBC scan of a table or parenthesised sub-query, split on ``partition_column`` when given.

    Bounds default to ``min``/``max`` of the partition column, read with one
    pushed-down aggregate query; that needs whole numbers. A text, date or skewed column is split at ``points``
    (``split_points`` of a sample): one task per range, as disjoint predicates. Filters applied to the result are pushed
    to the database by Spark, so no literal needs to be formatted into SQL.
    """
    if points is not None:
        if partition_column is None:
            raise ValueError("points need the partition column")
        properties = {k: v for k, v in jdbc_options(url, dbtable, **conn).items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, dbtable, predicates=split_predicates(partition_column, points), properties=properties)
    if partition_column is not None and bounds is None:
        probe = f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {dbtable} t) b"
        row = spark.read.format("jdbc").options(**jdbc_options(url, probe, **conn)).load().first()
        bounds = (int(row["lo"] or 0), int(row["hi"] or 0))
    opts = jdbc_options(url, dbtable, partition_column=partition_column, bounds=bounds,
                        num_partitions=num_partitions if partition_column else None, **conn)
    return spark.read.format("jdbc").options(**opts).load()


# ---- stage tables -----------------------------------------------------------------------

# A stage table is written once and read a few times, and all of a run's are there at once.
STAGE_COMPRESSION = "zstd"


def _stage_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-stages/{spark.sparkContext.applicationId}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the session's checkpoint folder and read it back.

    This cuts lineage at a stage boundary (one job, no recomputation), keeps
    the data columnar so later filters and projections push into the scan,
    and lives in the shared folder the cluster names in ``spark.checkpoint.dir``,
    so a lost executor never loses a finished stage. ``drop_stages`` removes them.
    """
    spark = df.sparkSession
    path = f"{_stage_root(spark)}/{name}"
    df.write.mode("overwrite").option("compression", STAGE_COMPRESSION).parquet(path)
    free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def stage_measured(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``stage_table``, and the bytes of its values, observed while they are written (no job of its own)."""
    seen = Observation()
    staged = stage_table(df.observe(seen, total_bytes(df).alias("bytes")), name)
    return staged, seen.get["bytes"]


def stage_by_key(df: DataFrame, name: str, keys: Sequence[str], buckets: int, moved: bool = True) -> DataFrame:
    """``stage_table``, bucketed by ``keys``: groups and windows that contain the keys read it without a shuffle.

    Two such stages with as many buckets meet on exactly these keys without one, too, and so does a frame that was given
    ``repartition(buckets, *keys)``. With ``moved=False`` the rows are known to be clustered by the keys already and stay
    in their tasks. The catalog entry that a bucketed write needs is removed at once; the files stay as for any stage.
    """
    spark = df.sparkSession
    table = f"tidemark_stage_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, *keys) if moved else df
    rows.write.mode("overwrite").option("path", f"{_stage_root(spark)}/{name}").option(
        "compression", STAGE_COMPRESSION).bucketBy(buckets, *keys).saveAsTable(table)
    free_shuffles(spark)
    staged = spark.table(table)
    spark.sql(f"DROP TABLE {table}")     # an external table: its files stay
    return staged


def drop_stages(spark: SparkSession, name: str | None = None) -> None:
    """Remove the stage tables of this application, or those below ``name``, once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_stage_root(spark)}/{name}" if name else _stage_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_stage(df: DataFrame, table: str, mode: str = "overwrite", keys: Sequence[str] = (), buckets: int = 0) -> None:
    """Append to or replace a managed stage table (``saveAsTable``).

    With ``keys`` and ``buckets`` it is bucketed and sorted by the keys: a join on exactly these keys then moves the other
    side alone, and two tables with the same buckets meet without any shuffle. Rows are clustered before the write, so
    each bucket is one file per write.
    """
    if keys:
        df.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    else:
        df.write.mode(mode).saveAsTable(table)


def truncate(spark: SparkSession, *tables: str) -> None:
    """``TRUNCATE TABLE`` for each table (stages written with ``overwrite`` need no separate step)."""
    for t in tables:
        spark.sql(f"TRUNCATE TABLE {t}")
