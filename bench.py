"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the table folder, BENCH_CPUS (default 8)
the number of local threads, BENCH_QUERIES an optional comma-separated choice.
"""

from __future__ import annotations

import json
import os
import time

from seriesmill.plans.catalog import REGISTRY
from seriesmill.session import build_session

HEADLINE = [
    "monthly_mean_price",
    "observation_table",
    "describe_measures",
    "measure_box_plots",
    "price_histogram",
    "price_density",
    "skewness_and_kurtosis",
    "null_report",
    "mean_imputation",
    "correlation_triangle",
    "engineered_correlation_triangle",
    "row_positions",
    "lag_with_head_filled",
    "rolling_means",
    "back_fill",
    "user_series_windows",
    "supervised_window",
    "expanding_window_folds",
    "engineered_features",
    "regression_scores",
    "worst_twenty",
    "fold_score_summary",
    "cross_product_sums",
    "monthly_autoregression_by_segment",
    "window_forecast_by_event_type",
    "linear_model_scores",
    "boosted_tree_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Load JVM classes and start the Python workers before timing.
    REGISTRY["row_positions"].run(spark, folder).count()
    spark.range(0, 8, 1, 8).mapInArrow(lambda batches: batches, "id long").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
