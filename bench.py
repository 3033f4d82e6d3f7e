"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sitetally.plans import catalog  # noqa: E402
from sitetally.session import build_session  # noqa: E402

HEADLINE = (
    "site_flags", "site_hits", "pattern_hits", "site_features", "host_report", "error_runs", "politeness_gap", "dedup_listings",
    "practices_with_ids", "city_topup", "vendor_counts", "market_share", "enrich_jobs", "summary_adoption",
    "phone_distribution", "robots_allowed", "robots_asof", "budget_cap", "stream_page_hits", "stream_host_state",
)
#: Table that a query's time grows with, for rows a second.
READS = {"host_report": "events", "error_runs": "events", "politeness_gap": "events", "stream_host_state": "events", "robots_asof": "events",
         "dedup_listings": "part", "practices_with_ids": "customer", "city_topup": "customer", "vendor_counts": "orders",
         "market_share": "orders", "enrich_jobs": "orders", "summary_adoption": "orders", "phone_distribution": "orders", "budget_cap": "orders"}


def shuffle_bytes(df) -> int:
    """Bytes that the shuffles of a query wrote, from the metrics of its final plan."""
    df.collect()

    def of(plan) -> int:
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return of(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return of(plan.plan())
        own = plan.metrics()
        total = own.apply("shuffleBytesWritten").value() if own.contains("shuffleBytesWritten") else 0
        children = plan.children()
        return total + sum(of(children.apply(i)) for i in range(children.size()))
    return of(df._jdf.queryExecution().executedPlan())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the engine
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in {"pages", *READS.values()}}
    speed = {name: round(rows[READS.get(name, "pages")] / t) for name, t in times.items()}
    moved = {"site_hits": shuffle_bytes(catalog.QUERIES["site_hits"](spark, sf_dir))}  # no page body may be among them
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows_per_s": speed, "shuffle_bytes": moved, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
