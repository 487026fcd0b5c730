"""Run parameters: the incremental window of one run.

The source job computes a cutoff per category (logged date minus N days, or a
default start when nothing is logged), then derives five date strings from it.
Here that is one immutable object; every filter built from it is a literal, so
Catalyst can fold it and push it into the scan.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import to_text


@dataclass(frozen=True)
class RunDates:
    """Window of one run: ``[cutoff, today]`` plus the derived boundaries."""

    cutoff: _dt.date
    today: _dt.date

    @property
    def cutoff_scd(self) -> _dt.date:
        """Last day before the window: history versions covering it are reopened."""
        return self.cutoff - _dt.timedelta(days=1)

    @property
    def yesterday(self) -> _dt.date:
        return self.today - _dt.timedelta(days=1)

    # yyyyMMdd text forms, for comparisons against text-date columns.
    @property
    def cutoff_text(self) -> str:
        return to_text(self.cutoff)

    @property
    def cutoff_scd_text(self) -> str:
        return to_text(self.cutoff_scd)

    @property
    def today_text(self) -> str:
        return to_text(self.today)

    @property
    def yesterday_text(self) -> str:
        return to_text(self.yesterday)


class RowDates:
    """The boundaries of ``RunDates`` as columns, from a column that holds each row's own cutoff.

    Every filter that takes ``RunDates`` takes this as well: the conditions are the same, with columns for literals.
    """

    def __init__(self, cutoff: str, today: _dt.date):
        self.cutoff = F.col(cutoff)
        self.today = today
        self.yesterday = today - _dt.timedelta(days=1)
        self.cutoff_scd = F.date_sub(self.cutoff, 1)
        self.cutoff_text = F.date_format(self.cutoff, "yyyyMMdd")
        self.cutoff_scd_text = F.date_format(self.cutoff_scd, "yyyyMMdd")
        self.today_text = to_text(self.today)
        self.yesterday_text = to_text(self.yesterday)


@dataclass(frozen=True)
class CategoryWindows:
    """Windows of one run in which every category has its own cutoff.

    ``cutoffs`` (``subscription_category, cutoff_date``, one row per category) is joined to the subscriptions; ``first``
    and ``last`` are the least and greatest cutoff, literals that bound the scans before a row's category is known.
    """

    cutoffs: DataFrame
    first: _dt.date
    last: _dt.date
    today: _dt.date

    @classmethod
    def of(cls, cutoffs: DataFrame, today: _dt.date) -> "CategoryWindows":
        """From a frame of cutoffs (pass a staged one): one aggregate, two dates to the driver."""
        row = cutoffs.agg(F.min("cutoff_date").alias("first"), F.max("cutoff_date").alias("last")).first()
        return cls(cutoffs.select("subscription_category", "cutoff_date"), row["first"] or today, row["last"] or today, today)

    @property
    def earliest(self) -> RunDates:
        return RunDates(self.first, self.today)

    @property
    def latest(self) -> RunDates:
        return RunDates(self.last, self.today)

    def row(self, column: str = "cutoff_date") -> RowDates:
        return RowDates(column, self.today)


@dataclass(frozen=True)
class RunParams:
    """Inputs of the cutoff lookup (the job's widgets)."""

    as_of: _dt.date
    days_back: int = 3
    default_start: _dt.date = _dt.date(1998, 1, 1)
    full_load: bool = False
    # the rest of the cutoff log's key: rows of other schemas, groups, workflows and attributes are not this job's
    schema_name: str = "common"
    group_name: str = "SUBSCRIPTION"
    workflow_name: str = "STATUS_HISTORY"
    attribute_name: str = "CUTOFF"

    def log_workflow(self, category: Column) -> Column:
        """The workflow's name in the log: one entry per category."""
        return F.concat(F.lit(self.workflow_name), F.lit("_"), category)

    def log_rows(self, cutoffs: DataFrame, category: str = "subscription_category") -> DataFrame:
        """The log entries of a finished run: every category at ``as_of``."""
        return cutoffs.select(
            F.lit(self.schema_name).alias("schma_nm"), F.lit(self.group_name).alias("grp_nm"),
            self.log_workflow(F.col(category)).alias("wrkflw_nm"), F.lit(self.attribute_name).alias("attr_nm"),
            F.lit(self.as_of).alias("attr_val_dt"))


def cutoff_lookup(categories: DataFrame, cutoff_log: DataFrame, params: RunParams,
                  category: str = "subscription_category") -> DataFrame:
    """Per category: logged date minus ``days_back``, or ``default_start`` when not logged.

    ``cutoff_log`` (``schma_nm, grp_nm, wrkflw_nm, attr_nm, attr_val_dt``) is looked up by its whole key, so another
    workflow's row never moves this job's cutoff; of several rows with one key the latest date counts. After a
    size check the matching rows are broadcast. Categories without one fall back to the default.
    """
    from tidemark.operators.common import broadcast_bounded

    log = cutoff_log.where((F.col("schma_nm") == params.schema_name) & (F.col("grp_nm") == params.group_name)
                           & (F.col("attr_nm") == params.attribute_name)).groupBy(
        F.col("wrkflw_nm").alias("_workflow")).agg(F.max("attr_val_dt").alias("_dt"))
    default = F.lit(params.default_start)
    cutoff: Column
    if params.full_load:
        cutoff = default
    else:
        cutoff = F.coalesce(F.date_sub(F.col("_dt"), params.days_back), default)
    return (
        categories.join(broadcast_bounded(log), params.log_workflow(F.col(category)) == F.col("_workflow"), "left")
        .select(F.col(category), cutoff.alias("cutoff_date"))
    )


def run_dates_frame(cutoffs: DataFrame, as_of: _dt.date, category: str = "subscription_category") -> DataFrame:
    """The five date parameters of a run, one row per category, as columns."""
    c = F.col("cutoff_date")
    today = F.lit(as_of)
    return cutoffs.select(
        F.col(category),
        c.alias("cutoff_date"),
        F.date_sub(c, 1).alias("cutoff_scd_date"),
        F.date_format(F.date_sub(c, 1), "yyyyMMdd").alias("cutoff_scd_text"),
        F.date_format(c, "yyyyMMdd").alias("cutoff_text"),
        F.date_format(today, "yyyyMMdd").alias("today_text"),
        F.date_format(F.date_sub(today, 1), "yyyyMMdd").alias("yesterday_text"),
    )
