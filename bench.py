"""Seconds per headline query, one JSON line.

Environment: BENCH_SF_DIR (folder of tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs per query, median taken).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.catalog import QUERIES
from tidemark.plans import analytics as a, charts as c
from tidemark.session import local_session
from tidemark.sources.star import star_from_orders

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Dashboard queries over the order-line star, the largest facts at hand; windows count from the last order.
STAR_QUERIES = {
    "q_kpi": lambda s: a.kpis(s, "365 DAYS"),
    "q_hourly": lambda s: a.hourly_activity(s, "365 DAYS"),
    "q_daily": lambda s: a.daily_activity(s, "365 DAYS"),
    "q_plan": lambda s: a.activity_by_plan(s, "365 DAYS"),
    "q_topfeat": lambda s: a.top_features(s, "365 DAYS"),
    "q_adopt": lambda s: a.feature_adoption(s, "365 DAYS"),
    "q_heatmap": lambda s: a.feature_heatmap(s),
    "q_sankey": lambda s: a.conversion_flow(s, "365 DAYS"),
    "q_attr": lambda s: a.attribution(s, "365 DAYS"),
    "q_recent_conv": lambda s: a.recent_conversions(s),
    "q_summary": lambda s: a.activity_summary(s, "365 DAYS"),
    "q_funnel": lambda s: a.conversion_funnel(s, "365 DAYS"),
    "bi_heatmap": lambda s: c.heatmap(
        c.Dataset(a.feature_heatmap_recent(s, "365 DAYS")), c.Metric.of("usage_count"), "plan", "feature_name"
    ),
}

# Registered queries of the other workloads.
CATALOG_QUERIES = [
    "ing_6", "ing_10", "ing_13", "dq_2", "dq_4", "tel_8", "st_1", "st_3",
    "tx_1", "tx_2", "tx_4", "tx_6", "tx_7", "tx_8", "tx_9", "vs_1", "vs_2",
    "tel_1", "tel_3", "ing_9", "ing_20", "st_2", "st_4",
]


def seconds(build) -> float:
    times = []
    for number in range(RUNS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        if number:  # the first run warms up
            times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = local_session("bench", CPUS, shuffle_partitions=int(CPUS), memory="16g")
    results = {}
    for name, query in STAR_QUERIES.items():
        results[name] = seconds(lambda q=query: q(star_from_orders(spark, FOLDER)))
    for name in CATALOG_QUERIES:
        results[name] = seconds(lambda n=name: QUERIES[n](spark, FOLDER))
    print(
        json.dumps(
            {
                "metric": "total of median seconds per headline query",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
