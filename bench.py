"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (every row is
produced, nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_period_mix", "feature_engineer", "column_prune", "corr_matrix", "describe", "median_impute",
    "preprocess_fit_transform", "stratified_split", "oversample", "scorecard", "roc_points", "calibration_bins",
    "score_batch", "ensemble_interval", "knn_join", "knn_classify", "mutual_information", "permutation_importance",
    "shapley_linear", "shap_local", "fit_logistic", "fit_forest", "fit_boosted",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from kestrel.plans import catalog
    from kestrel.session import checkpoint_dir, get_spark
    spark = get_spark(f"local[{cpus}]", app="kestrel-bench", shuffle_partitions=int(cpus))
    checkpoint_dir(spark)
    spark.conf.set("spark.kestrel.scan.minPartitions", cpus)      # the bench files have one row group each
    qs = catalog.queries()
    # warm-up (JVM, Python workers), not timed
    qs["label_encode"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, rows = {}, {}
    for name in names:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
