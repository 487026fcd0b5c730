"""Incremental runs driven by a cutoff log (the job's watermark).

The source job is incremental in batch form: each run re-reads the last
``days_back`` days before the logged cutoff, so late changes are picked up,
and merges by key, so re-processing a day is idempotent. This module runs
that loop: look up the cutoff of every category (one small aggregate), run
one job in which the cutoff is a column of the category, merge its result
into the table, and only then return the log rows to append.

``foreach_batch_upsert`` is the same merge for change rows that arrive as a
Structured Streaming source: ``writeStream.foreachBatch`` hands each
micro-batch to the bucket-wise merge of ``MergeTable``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import deltas as dl
from tidemark.operators.common import ITEM_KEYS, VERSION_KEYS
from tidemark.params import CategoryWindows, RunParams, cutoff_lookup
from tidemark.plans.status_history import FINAL_COLS, HistorySources, StatusHistoryJob
from tidemark.sources.merge_table import MergeTable
from tidemark.sources.tables import drop_stages, stage_table


@dataclass
class RunResult:
    job: StatusHistoryJob
    windows: CategoryWindows
    next_log: DataFrame


def category_windows(src: HistorySources, cutoff_log: DataFrame, params: RunParams, stage: str) -> CategoryWindows:
    """The cutoffs of all categories, staged (the log changes after the run); two dates reach the driver."""
    cutoffs = stage_table(cutoff_lookup(dl.distinct_categories(src.dim), cutoff_log, params), stage)
    return CategoryWindows.of(cutoffs, params.as_of)


def run_incremental(spark: SparkSession, src: HistorySources, cutoff_log: DataFrame, params: RunParams,
                    sink: MergeTable | None = None, materialize: str | None = "stage") -> RunResult:
    """One incremental run, one job for all categories however many cutoffs they have; merges into ``sink`` if given.

    Returns the job (its frames, when there is no sink), the windows, and the cutoff-log rows to append (category,
    today) once the merge succeeded; the log is never written here. After a merge the stages of the run are dropped.
    """
    windows = category_windows(src, cutoff_log, params, f"cutoffs/{uuid.uuid4().hex[:12]}")
    own = src if sink is None else replace(src, target=sink.read(spark))
    job = StatusHistoryJob(own, windows, materialize=materialize)
    if sink is not None:
        # both sources are staged before the first merge changes the target they were derived from
        rows, ranges = job.final_rows, job.plan_ranges
        sink.upsert(rows, VERSION_KEYS, update=FINAL_COLS[4:], insert=FINAL_COLS)
        sink.range_update(ranges, keys=ITEM_KEYS, at="start_date", start="bp_start_date",
                          end="bp_end_date", set_col="upd_ind", from_col="bp_upd_ind",
                          target_key=VERSION_KEYS, on_multi="latest",
                          prefer=["bp_start_date", "bp_item", "bp_no"])
        job.drop_stages()
        drop_stages(spark, f"merge/{sink.name}")
    return RunResult(job, windows, params.log_rows(windows.cutoffs))


def foreach_batch_upsert(sink: MergeTable, keys: Sequence[str], update: Sequence[str] | None = None,
                         insert: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function merging each micro-batch into ``sink``.

    A batch holding two rows for one key fails the merge's cardinality check,
    as MERGE does; no row is silently preferred.
    """
    def apply(batch: DataFrame, epoch_id: int) -> None:
        sink.upsert(batch, keys, update, insert)
    return apply
