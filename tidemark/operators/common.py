"""Small helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Natural key of a subscription item and of its history versions.
ITEM_KEYS = ["client", "sales_document", "sales_document_item"]
VERSION_KEYS = ITEM_KEYS + ["start_date"]

# Largest frame that is broadcast, by its measured bytes (uncompressed values).
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Bytes per value of fixed-width types.
FIXED_WIDTH = {
    T.IntegerType: 4, T.DateType: 4, T.FloatType: 4, T.LongType: 8, T.DoubleType: 8,
    T.TimestampType: 8, T.TimestampNTZType: 8, T.BooleanType: 1, T.ShortType: 2, T.ByteType: 1,
}


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def value_bytes(value: Column, dtype: T.DataType) -> tuple[int, Column | None]:
    """(fixed bytes per row, variable size or None) of a column of the type.

    Nested values of varying size count as their JSON text.
    """
    if type(dtype) in FIXED_WIDTH:
        return FIXED_WIDTH[type(dtype)], None
    if isinstance(dtype, T.DecimalType):
        return (8 if dtype.precision <= 18 else 16), None
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return 0, F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(dtype, T.ArrayType) and type(dtype.elementType) in FIXED_WIDTH:
        return 0, F.when(value.isNull(), 0).otherwise(F.size(value) * FIXED_WIDTH[type(dtype.elementType)])
    if isinstance(dtype, T.NullType):
        return 0, None
    return 0, F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("v")))), F.lit(0))


def total_bytes(df: DataFrame) -> Column:
    """Aggregate: size of the values of ``df`` in bytes."""
    sizes = [value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    total = F.lit(sum(n for n, _ in sizes)) * F.count(F.lit(1))
    varying = [v for _, v in sizes if v is not None]
    if varying:
        total = total + F.coalesce(F.sum(reduce(lambda a, b: a + b, varying)), F.lit(0))
    return total.cast("bigint")


def broadcast_bounded(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only after measuring it: at most ``max_bytes`` of values.

    The measure is one aggregate (partial sums per task), so pass a staged or otherwise cheap frame. A larger one
    is returned without a hint, and Spark (and AQE, with runtime sizes) picks a shuffle join.
    """
    return F.broadcast(df) if is_bounded(df, max_bytes) else df


def is_bounded(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return df.agg(total_bytes(df).alias("n")).first()["n"] <= max_bytes


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)
