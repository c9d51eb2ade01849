"""Time the headline queries: one JSON line with seconds per query, the second run of each.

Environment: BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from tabforge.catalog import QUERIES
from tabforge.session import build_session

HEADLINE = [
    "profile_lineitem", "column_profile_orders", "missing_summary_inj", "numeric_describe_lineitem",
    "outlier_shares_events", "encoding_advice_part", "target_corr_quality", "multicollinear_lineitem",
    "numeric_vs_class", "crosstab_flag_status", "quality_flags_orders", "duplicate_rows_lineitem",
    "universal_eda_orders", "datetime_summary_events", "volume_trend_orders_month", "time_quartile_target",
    "date_parts_orders", "holiday_features_orders", "lag_features_daily_revenue", "lag_features_by_event_type",
    "lag_features_events_raw", "impute_median", "impute_mode", "standard_scale", "one_hot_flags", "preprocess_vector",
    "split_two_way", "split_three_way_strat", "split_chrono", "folds_stratified", "folds_expanding",
    "cls_metrics", "cls_metrics_multiclass", "roc_auc", "reg_metrics", "confusion", "calibration",
    "drift_report", "class_psi", "ks_two_sample", "histograms", "corr_matrix", "boxplot_stats", "roc_points",
    "pred_vs_actual", "simple_linear_fit", "ridge_fit", "cv_linear", "train_score_rf", "train_logreg",
    "stream_volume", "stream_psi", "stream_score", "stream_lags",
]

def run(fn, spark, sf_dir: str) -> float:
    begun = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    scratch = tempfile.TemporaryDirectory(prefix="bench-")  # gone with its tables when the run ends
    spark = build_session("bench", f"local[{cpus}]", cpus, scratch.name)
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        run(QUERIES[name], spark, sf_dir)  # warm-up, the same for every query
        seconds[name] = round(run(QUERIES[name], spark, sf_dir), 3)
        print(name, seconds[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
