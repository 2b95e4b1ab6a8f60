"""Benchmark: prints one JSON line with the seconds of each headline query."""
from __future__ import annotations

import json
import os
import time

from cardwatch.plans.catalog import CATALOG
from cardwatch.session import local_session

HEADLINE = [
    "a_rate_hour", "q_quality_report", "q_distinct", "q_describe", "a_corr", "a_vif",
    "a_hist_density", "a_kde", "a_fraud_counts", "m_model_table", "m_folds", "m_bootstrap",
    "j_knn", "m_smote", "v_compare", "v_roc_all", "x_linear_shap", "d_score", "d_stream_score",
    "e_lr", "e_rf", "e_l2_sweep",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    CATALOG[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "12g"), partitions=cpus)
    run(spark, "f_temporal", folder)  # start the session and the code generator
    seconds = {name: round(run(spark, name, folder), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rsplit("sf", 1)[-1], "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
