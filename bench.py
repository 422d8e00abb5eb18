"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the no-op sink (the whole plan
executes, nothing is gathered on the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortlens.plans.catalog import QUERIES  # noqa: E402
from cohortlens.session import build_session, clear_scratch  # noqa: E402

HEADLINE = (
    "feature_table",        # 4 channel aggregations + member joins
    "churn_label",
    "process_features",     # label, engineer, impute (medians), clip (quantiles)
    "rank_by_risk",         # global sort of rule-scored members
    "at_risk_top",          # distributed top-k
    "member_search",
    "risk_summary",
    "daily_activity",       # 31-day zero-filled grid
    "member_timeline",      # nested per-member timeline
    "stratified_split",     # two-level stratified rank
    "classification_metrics",
    "roc_auc",
    "fit_logistic",         # Spark ML pipeline fit + hold-out scoring
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # warm-up: JVM start, class loading, first Parquet footers
    QUERIES["feature_table"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        clear_scratch(spark)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
