"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries"
(per-query seconds), "sf"}.  Each query is executed to completion with the
``noop`` sink (no driver collect).  The first two entries build and
materialise Silver and Gold (the pipeline), later queries reuse them.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q1_top_neighbourhoods", "q2_occupancy_by_room_type", "q3_superhost_rating", "q4_weekend_availability",
    "joi5_duplicate_pairs", "agg3_neighbourhood_aggregates", "dq1_missing_report", "dq5_referential_integrity",
    "agg9_describe", "agg18_box_by_room_type", "agg20_monthly_reviews", "win3_win4_lorenz_gini",
    "geo3_hexbin_median_price", "sta1_welch_h1", "sta4_mann_whitney_h1", "sta6_anova_h4", "sta8_tukey_hsd",
    "sta12_correlation_matrix", "sta14_ols_coefficients", "str4_change_capture", "str6_weekly_review_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from innsight.plans.lake import lake
    from innsight.plans.registry import load_all
    from innsight.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="innsight-bench")
    reg = load_all()
    times: dict[str, float] = {}

    t0 = time.time()
    lk = lake(spark, sf_dir)
    for layer in ("listings", "calendar", "reviews_flagged"):
        getattr(lk, layer)  # materialised (checkpointed) on first access
    times["silver"] = time.time() - t0
    t0 = time.time()
    lk.gold  # noqa: B018
    times["gold"] = time.time() - t0

    for name in HEADLINE:
        builder, _ = reg[name]
        t0 = time.time()
        builder(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = time.time() - t0

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": {k: round(v, 3) for k, v in times.items()}, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
