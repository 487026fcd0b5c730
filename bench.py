"""Bench: registered queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

The source tables (billing plans, history, dimension, ...) are derived from the
given parquet tables once and staged, as they would be stored tables in
production; that setup is not timed. Each run starts with a new history job, so
every stage a query needs is computed in it, and writes to the ``noop`` sink
(full computation, no collect). The median of ``$BENCH_RUNS`` runs after
one warm-up run is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import queries as Q  # noqa: E402
from tidemark.plans.status_history import HistorySources, StatusHistoryJob  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources.fixtures import VIEWS, Fixtures  # noqa: E402
from tidemark.sources.tables import drop_stages  # noqa: E402


def timed(fn, runs: int) -> float:
    times = []
    fn().write.format("noop").mode("overwrite").save()  # warm-up, not timed
    for _ in range(runs):
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="tidemark-bench")
    fixtures = Fixtures(spark, sf_dir)
    for name in VIEWS:
        fixtures.table(name)
    src = HistorySources.from_fixtures(fixtures)
    registered = Q.queries()

    def query(name: str):
        def run():
            Q.forget_jobs()
            return registered[name](spark, sf_dir)
        return run

    def pipeline_per_category():
        """The whole job, both merges included, once per category."""
        out = None
        for cat in sorted(r[0] for r in src.dim.select("subscription_category").distinct().collect()):
            df = StatusHistoryJob(src, Q.FIXTURE_DATES, categories=[cat]).merged_with_plan_flag
            out = df if out is None else out.unionByName(df)
        return out

    headline = {
        "collapse_close": query("close_intervals"),
        "link_versions": query("link_versions"),
        "delta_union_distinct": query("delta_union_distinct"),
        "status_rules": query("status_rules"),
        "enrich_final": query("enrich_final"),
        "merge_upsert": query("merge_upsert"),
        "pipeline_one_job": query("merge_range_update"),
        "pipeline_per_category": pipeline_per_category,
    }
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    results = {}
    for name, fn in headline.items():
        if only and name not in only:
            continue
        results[name] = round(timed(fn, runs), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "median_query_seconds_total", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "runs": runs}))
    drop_stages(spark)


if __name__ == "__main__":
    main()
