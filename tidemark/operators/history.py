"""Window operators over a versioned history: one spec, partitioned by key, ordered by start.

All steps share ``Window.partitionBy(keys).orderBy(order)``; chained, Spark
plans one exchange and one sort for the whole chain (the filters between the
steps keep the partitioning and the order), so the cost is one shuffle of the
rows no matter how many steps run.

A key's rows all go to one task under that spec. Every operator therefore
takes ``split``, the segment column of rows of keys too large for one task: they
are computed in segments and stitched together, with the same result. Use
``by_key_size`` (``tidemark.operators.neighbors``), which finds the hot keys
once and runs a whole chain of steps both ways. The history job's own window
pass does not need it: after one version per ``(key, start)`` a key has at most
one row per day of the run window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tidemark.functions.dates import OPEN_END
from tidemark.operators.common import ITEM_KEYS
from tidemark.operators.neighbors import with_neighbors

c = F.col

ACTIVE = "ACTIVE"
INACTIVE = "INACTIVE"


def _with_prev(df: DataFrame, keys, order, src: str, out: str, split: str | None, lead: bool = False) -> DataFrame:
    """``out`` = previous (or, with ``lead``, next) value of ``src`` per key in ``order``."""
    if split is None:
        fn = F.lead if lead else F.lag
        return df.withColumn(out, fn(src).over(version_window(keys, order)))
    if len(order) != 1 or not isinstance(order[0], str):
        raise ValueError("split rows are ordered by exactly one column")
    spec = {src: out}
    return with_neighbors(df, keys, order[0], lead_cols=spec if lead else None, lag_cols=None if lead else spec,
                          segment=split)


def version_window(keys: Sequence[str] = ITEM_KEYS, order: Sequence[str | Column] = ("start_date",)):
    return Window.partitionBy(*keys).orderBy(*[c(o) if isinstance(o, str) else o for o in order])


def lag_status(df: DataFrame, keys: Sequence[str] = ITEM_KEYS, order: Sequence[str] = ("start_date",),
               status: str = "subscription_status", out: str = "lag_subscription_status",
               split: str | None = None) -> DataFrame:
    """Previous version's status (NULL on the first version)."""
    return _with_prev(df, keys, order, status, out, split)


def drop_reactivation(df: DataFrame, keys: Sequence[str] = ITEM_KEYS, order: Sequence[str] = ("start_date",),
                      status: str = "subscription_status", reason: str = "cancellation_reason",
                      old_reason: str = "cancellation_reason_old", split: str | None = None) -> DataFrame:
    """Drop ACTIVE-after-INACTIVE rows whose cancellation reason went SA -> SC (reactivation noise).

    A NULL comparison does not mark the row as noise, so it is kept.
    """
    d = _with_prev(df, keys, order, status, "_prev", split)
    noise = (c(status) == ACTIVE) & (c("_prev") == INACTIVE) & (c(reason) == "SC") & (c(old_reason) == "SA")
    return d.where(~F.coalesce(noise, F.lit(False))).drop("_prev")


def collapse_runs(df: DataFrame, keys: Sequence[str] = ITEM_KEYS, order: Sequence[str] = ("start_date",),
                  status: str = "subscription_status", split: str | None = None) -> DataFrame:
    """Gaps-and-islands: keep the first row of every run of equal status.

    A row survives unless its status equals the previous row's; the first row
    of a key (NULL previous) always survives.
    """
    d = _with_prev(df, keys, order, status, "_prev", split)
    return d.where(~F.coalesce(c(status) == c("_prev"), F.lit(False))).drop("_prev")


def link_versions(df: DataFrame, keys: Sequence[str] = ITEM_KEYS, order: Sequence[str] = ("start_date",),
                  link: str = "link_id", prev_link: str = "prev_link_id", split: str | None = None) -> DataFrame:
    """Back-link each version to its predecessor's link id."""
    d = _with_prev(df.drop(prev_link) if prev_link in df.columns else df, keys, order, link, prev_link, split)
    return d.select(*[c(x) for x in df.columns] + ([c(prev_link)] if prev_link not in df.columns else []))


def close_intervals(df: DataFrame, keys: Sequence[str] = ITEM_KEYS, order: Sequence[str] = ("start_date",),
                    start: str = "start_date", end: str = "end_date", split: str | None = None) -> DataFrame:
    """End of each version = next version's start minus one unit; the last version stays open.

    Dates step by one day and end on 9999-12-31; timestamps step by one
    microsecond and end on 9999-12-31 00:00:00.
    """
    cols = df.columns + ([end] if end not in df.columns else [])
    df = _with_prev(df, keys, order, start, "_next", split, lead=True)
    nxt = c("_next")
    if isinstance(df.schema[start].dataType, DateType):
        closed = F.coalesce(F.date_sub(nxt, 1), F.lit(OPEN_END))
    else:
        closed = F.coalesce(nxt - F.expr("INTERVAL 1 MICROSECOND"),
                            F.lit("9999-12-31 00:00:00").cast(df.schema[start].dataType))
    return df.withColumn(end, closed).select(*cols)


def close_intervals_observed(df: DataFrame, keys: Sequence[str] = ITEM_KEYS, order: Sequence[str] = ("start_date",),
                             start: str = "start_date", end: str = "end_date", link: str = "link_id",
                             prev_link: str = "prev_link_id", split: str | None = None) -> DataFrame:
    """Parity variant of linking + closing without ``otherwise``.

    Only the last version gets an end ('9999-12-31' as text, others NULL) and
    only the first version keeps its ``prev_link``.
    """
    d = _with_prev(df, keys, order, link, "_prev_link", split)
    d = _with_prev(d, keys, order, start, "_next_start", split, lead=True)
    return d.withColumn(prev_link, F.when(c("_prev_link").isNull(), c(prev_link))).withColumn(
        end, F.when(F.date_sub("_next_start", 1).isNull(), F.lit("9999-12-31"))).drop("_prev_link", "_next_start")


def one_version_per_start(df: DataFrame, keys: Sequence[str] = ITEM_KEYS, start: str = "start_date",
                          status: str = "subscription_status") -> DataFrame:
    """Resolve rows that share ``(keys, start)`` to one, deterministically.

    INACTIVE wins over ACTIVE; remaining ties go to the smallest row in column
    order (NULLs first). Expressed as ``min_by`` over a struct, which Spark
    aggregates partially on the map side (by sorting, as a struct is no
    fixed-width buffer): a key with very many rows is reduced before the shuffle.
    """
    cols = [x for x in df.columns if x not in (*keys, start)]
    rank = F.when(c(status) == INACTIVE, 0).when(c(status) == ACTIVE, 1).otherwise(2)
    ordering = F.struct(rank.alias("_rank"), *[c(x) for x in cols])
    best = F.min_by(F.struct(*[c(x) for x in cols]), ordering).alias("_best")
    return df.groupBy(*keys, start).agg(best).select(*keys, start, *[c(f"_best.{x}") for x in cols]).select(*df.columns)
