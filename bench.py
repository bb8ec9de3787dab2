"""Time the headline queries: one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) pick data and cores.
Every query is written in full to Spark's no-op sink, so no result row is left uncomputed.
"""

from __future__ import annotations

import json
import os
import time

from tidecast.catalog import all_queries
from tidecast.session import local_session

HEADLINE = (
    "ts_daily_series",
    "ts_regularize",
    "ts_regularize_ffill",
    "ts_infer_freq_h",
    "ts_static_join",
    "ts_holdout_split",
    "fc_seasonal_naive",
    "fc_drift",
    "fc_nations_seasonal_naive",
    "fc_weekly_seasonal_naive",
    "fc_backtest_metrics",
    "fc_leaderboard",
    "fc_fit_predict",
    "fc_smooth_weekly",
    "fc_lag_regression",
    "fc_to_nested_json",
    "json_to_series",
    "tab_gnb",
    "tab_fit_predict_proba",
    "tab_regression",
    "tab_bagged",
    "tab_sample_n",
    "udf_score_rows",
    "text_classify",
    "embedding_classify",
    "img_content_name",
    "stream_predict_proba",
    "stream_forecast",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "12g", "tidecast-bench")
    known = all_queries()
    warm = known["ts_daily_series"](spark, sf_dir)
    warm.write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
