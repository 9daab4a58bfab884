"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. Each query is run to completion once, after a short warm-up on
the smallest part of the engine; the value is the sum over queries.
"""

import json
import os
import time

from creditflow.plans.queries import QUERIES
from creditflow.session import local_session

HEADLINE = (
    "sample_window_filter", "impute_numeric", "woe_iv_fixed", "bin_decision", "woe_apply_wide",
    "gini_train_oot", "bin_trend_report", "scorecard_score", "dq_suite", "feat_totals_activity",
    "feat_rolling_daily", "feat_settlement_averages", "feat_counterparty", "base_scan_project",
    "activity_woe_iv", "woebin_fit", "woebin_search", "scorecard_fit", "gbt_score", "pca_components",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "creditflow-bench")
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["train_oot_split"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
