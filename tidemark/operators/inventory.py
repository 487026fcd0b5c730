"""Table-size inventory: a ``(name, sizeinbytes)`` frame and two size reports.

Three measures: ``stored_sizes`` lists files (no data is read; the one for large tables), ``catalog_sizes`` does so for
the folders that the session catalog names, and ``table_sizes`` reads the tables for the size of their values, which does not depend
on the file format. The reports group by the parts of the three-part name.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.common import total_bytes

def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``name`` (three-part) and ``sizeinbytes``."""
    rows = [df.agg(F.lit(name).alias("name"), total_bytes(df).alias("sizeinbytes")) for name, df in tables.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def stored_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per table: ``name`` and the bytes of its files, from one listing of all tables.

    Spark lists many folders on the executors; no file is opened. A file counts for the table whose folder it lies in,
    found by equality with its parent folders. A table without files has size 0.
    """
    schema = "name string, root string"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def qualified(path: str) -> str:
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf).makeQualified(p).toString()

    roots = spark.createDataFrame([(name, qualified(path)) for name, path in paths.items()], schema)
    if not paths:
        return roots.select("name", F.lit(0).cast("long").alias("sizeinbytes"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sorted(set(paths.values())))
    parts = F.split("path", "/")
    parents = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.concat_ws("/", F.slice(parts, F.lit(1), k)))
    per_file = files.select("length", F.explode(parents).alias("root"))
    return roots.join(per_file, "root", "left").groupBy("name").agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("sizeinbytes"))


def _parts(name: Column) -> tuple[Column, Column, Column]:
    return (F.substring_index(name, ".", 1), F.substring_index(F.substring_index(name, ".", 2), ".", -1),
            F.substring_index(name, ".", -1))


def without_schemas(info: DataFrame, schemas: Sequence[str]) -> DataFrame:
    """Rows of ``info`` whose schema is none of ``schemas`` (text inequality on the second part of the name)."""
    _, schema, _ = _parts(F.col("name"))
    return info.where(reduce(lambda a, b: a & b, [schema != s for s in schemas], F.lit(True)))


def inventory_by_schema(info: DataFrame, unit: float = 1e9, size_col: str = "schema_size_gb") -> DataFrame:
    """Schema sizes: sum of per-table sizes rounded to 2 decimals in ``unit``; empty schemas dropped."""
    cat, sch, _ = _parts(F.col("name"))
    per_table = F.round(F.col("sizeinbytes") / F.lit(unit), 2)
    return (info.where(F.col("sizeinbytes") > 0)
            .groupBy(cat.alias("catalog_name"), sch.alias("schema_name"))
            .agg(F.round(F.sum(per_table), 2).alias(size_col))
            .where(F.col(size_col) > 0)
            .orderBy(F.col(size_col).desc()))


def inventory_by_table(info: DataFrame, unit: float = 1e9, size_col: str = "sizeingb") -> DataFrame:
    """Per-table sizes in bytes and in ``unit``, largest first."""
    cat, sch, tbl = _parts(F.col("name"))
    return (info.where(F.col("sizeinbytes") > 0)
            .select(cat.alias("catalog_name"), sch.alias("schema_name"), tbl.alias("table_name"),
                    "sizeinbytes", F.round(F.col("sizeinbytes") / F.lit(unit), 2).alias(size_col))
            .orderBy(F.col("sizeinbytes").desc()))


def catalog_tables(spark: SparkSession, skip_catalogs=("samples", "system"),
                   skip_schemas=("information_schema", "default")) -> tuple[dict[str, str], DataFrame]:
    """Folders of the managed tables of all catalogs, and one error row per schema that failed.

    One statement per schema; views and external tables are left out. An error row holds class, parameters and SQLSTATE
    instead of a printed message. Only metadata crosses the driver.
    """
    folders: dict[str, str] = {}
    errors: list[tuple[str, str, str, str]] = []
    for cat in spark.catalog.listCatalogs():
        if cat.name in skip_catalogs:
            continue
        for schema in [r[0] for r in spark.sql(f"SHOW SCHEMAS IN `{cat.name}`").collect()]:
            if schema in skip_schemas:
                continue
            try:
                for t in spark.sql(f"SHOW TABLE EXTENDED IN `{cat.name}`.`{schema}` LIKE '*'").collect():
                    facts = dict(x.split(": ", 1) for x in t["information"].splitlines() if ": " in x)
                    if facts.get("Type") == "MANAGED" and not t["isTemporary"] and "Location" in facts:
                        folders[f"{cat.name}.{schema}.{t['tableName']}"] = facts["Location"]
            except PySparkException as ex:
                errors.append((f"{cat.name}.{schema}", str(ex.getCondition()),
                               str(ex.getMessageParameters()), str(ex.getSqlState())))
    return folders, spark.createDataFrame(
        errors, "schema_name string, error_class string, parameters string, sqlstate string")


def catalog_sizes(spark: SparkSession, skip_catalogs=("samples", "system"),
                  skip_schemas=("information_schema", "default")) -> tuple[DataFrame, DataFrame]:
    """``(sizes, errors)``: ``name, sizeinbytes`` of every managed table, from one listing of their folders.

    Nothing is written to the catalog (no ANALYZE).
    """
    folders, errors = catalog_tables(spark, skip_catalogs, skip_schemas)
    return stored_sizes(spark, folders), errors
