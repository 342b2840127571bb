"""Time the registered headline queries and print one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the local cores, BENCH_RUNS the timed runs (the median counts, after one
warm-up), BENCH_QUERIES an optional comma-separated list instead of the headline queries (`all` for every query).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from seriesml.session import build_session

HEADLINE = (
    "flagship_rolling_forecast", "profile_overview", "profile_types", "profile_numeric", "profile_quantiles", "profile_corr",
    "profile_spearman", "profile_alerts", "profile_words", "clean_removable", "clean_dropna", "encode_label", "encode_onehot",
    "roll_mean", "feat_all", "feat_peaks", "feat_peak_frequency", "split_rows", "split_rows_by_series", "split_files",
    "scale_standard", "scale_robust", "seq_tumbling", "seq_overlap", "seq_target_future", "seq_flatten", "train_ols",
    "train_lda_1d", "train_dt", "knn_classify", "metrics_regression", "metrics_binary", "confusion_matrix", "uncertainty_entropy",
    "xai_importance", "xai_shapley_linear", "combine_weighted", "agreement_spearman", "emissions_full_run", "infer_batch",
    "json_payload_ingest", "stream_rolling",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    from seriesml.plans.catalogue import QUERIES
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in names:
        taken = []
        for i in range(runs + 1):
            at = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - at)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} first {taken[0]:.2f} warm {times[name]:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
