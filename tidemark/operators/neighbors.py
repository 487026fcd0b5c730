"""Previous/next-row values per key without putting a hot key into one task.

``lag``/``lead`` over ``Window.partitionBy(keys)`` sends every row of a key to
one task. ``by_key_size`` therefore finds the hot keys once (one aggregate),
runs a chain of window steps plainly on all other rows (one exchange, one
sort), and on the rows of the hot keys with neighbours computed in segments:

1. the hot rows are range-partitioned by key and order value, with cut points
   that Spark takes from a sample of the rows, so every segment holds about as
   many rows however densely they lie; the segment of each row is stored;
2. ``lag``/``lead`` run over ``(keys, segment)``;
3. the last row before each cut and the first one after it (``max_by`` /
   ``min_by`` aggregates, one row per key and segment) are carried over the cut:
   windowed over ``keys`` in the order of the segments and joined back.

Both ways give the same rows whatever the size of a key. The order column must
be unique within a key (ties make lag/lead nondeterministic anyway); NULLs come
first, as in a plain window.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.common import all_of, broadcast_bounded
from tidemark.sources.tables import stage_table

c = F.col
SEGMENT = "_nb_segment"


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and their ``count`` (at most ``rows / hot_rows`` keys)."""
    return df.groupBy(*keys).count().where(c("count") > hot_rows)


def cut_by_density(df: DataFrame, keys: Sequence[str], order: str, rows: int, segment_rows: int) -> DataFrame:
    """``df`` (of ``rows`` rows) stored with the segment of each row; a segment is a range of ``(keys, order)``.

    Rows that agree in both share a segment. The cut points come from a sample, so a segment holds ``segment_rows`` rows
    on average; it is stored because another sample would cut elsewhere.
    """
    parts = max(1, -(-rows // segment_rows))
    cut = df.repartitionByRange(parts, *keys, order).withColumn(SEGMENT, F.spark_partition_id())
    return stage_table(cut, f"segments/{uuid.uuid4().hex}")


def by_key_size(df: DataFrame, keys: Sequence[str], hot_rows: int, steps: Callable[[DataFrame, str | None], DataFrame],
                order: str = "start_date") -> DataFrame:
    """``steps(rows, split)`` on the rows of ordinary keys (split None) and of hot keys (split: their segment column).

    ``steps`` is a chain of the operators of ``tidemark.operators.history``, each called with ``split``. Without hot
    keys the plan is the plain chain over ``df``.
    """
    keys = list(keys)
    hot = stage_table(hot_keys(df, keys, hot_rows), f"hot-keys/{uuid.uuid4().hex}")
    rows = hot.agg(F.sum("count")).first()[0]
    if not rows:
        return steps(df, None)
    hot = broadcast_bounded(hot.drop("count"))
    # null-safe, so that rows with a null in their key stay with their key
    same = all_of([df[k].eqNullSafe(hot[k]) for k in keys])
    cut = cut_by_density(df.join(hot, same, "left_semi"), keys, order, rows, max(1, hot_rows // 2))
    return steps(df.join(hot, same, "left_anti"), None).unionByName(steps(cut, SEGMENT).drop(SEGMENT))


def with_neighbors(df: DataFrame, keys: Sequence[str], order: str, lag_cols: dict[str, str] | None = None,
                   lead_cols: dict[str, str] | None = None, segment: str = SEGMENT) -> DataFrame:
    """Add ``lag_cols`` (source -> output name) and ``lead_cols`` neighbour values per key.

    Equal to ``lag(src).over(w)`` / ``lead(src).over(w)`` with
    ``w = Window.partitionBy(keys).orderBy(order)``, for rows whose ``segment`` column rises with ``order`` within a
    key (``cut_by_density``; rows may have been filtered out since). The input is staged, as it is read twice.
    """
    keys = list(keys)
    lag_cols = dict(lag_cols or {})
    lead_cols = dict(lead_cols or {})
    rows = stage_table(df, f"neighbors/{uuid.uuid4().hex}")
    w = Window.partitionBy(*keys, segment).orderBy(order)
    place = F.struct(c(order).isNotNull(), c(order))
    inner = rows.withColumns({
        **{f"_nb_lag_{o}": F.lag(s).over(w) for s, o in lag_cols.items()},
        **{f"_nb_lead_{o}": F.lead(s).over(w) for s, o in lead_cols.items()},
        "_nb_first": F.lag(F.lit(1)).over(w).isNull(),
        "_nb_last": F.lead(F.lit(1)).over(w).isNull(),
    })
    # one row per (key, segment): its last values (for the next segment) and first values (for the previous one)
    aggs = [F.count(F.lit(1)).alias("_nb_n")]
    if lag_cols:
        aggs.append(F.max_by(F.struct(*[c(s).alias(o) for s, o in lag_cols.items()]), place).alias("_nb_lastv"))
    if lead_cols:
        aggs.append(F.min_by(F.struct(*[c(s).alias(o) for s, o in lead_cols.items()]), place).alias("_nb_firstv"))
    bounds = rows.groupBy(*keys, segment).agg(*aggs)
    wb = Window.partitionBy(*keys).orderBy(segment)
    edge = bounds.select(
        *[c(k).alias(f"_nb_{k}") for k in keys], c(segment).alias("_nb_at"),
        *([F.lag("_nb_lastv").over(wb).alias("_nb_prev")] if lag_cols else []),
        *([F.lead("_nb_firstv").over(wb).alias("_nb_next")] if lead_cols else []))
    same = all_of([c(k).eqNullSafe(c(f"_nb_{k}")) for k in keys] + [c(segment) == c("_nb_at")])
    out = inner.join(edge, same, "left")
    return out.select(
        *[c(x) for x in df.columns],
        *[F.when(c("_nb_first"), c(f"_nb_prev.{o}")).otherwise(c(f"_nb_lag_{o}")).alias(o) for o in lag_cols.values()],
        *[F.when(c("_nb_last"), c(f"_nb_next.{o}")).otherwise(c(f"_nb_lead_{o}")).alias(o) for o in lead_cols.values()],
    )
