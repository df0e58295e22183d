"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablesmith.session import build_session  # noqa: E402
from workloads import REGISTRY  # noqa: E402

HEADLINE = [
    "agg_target_rate", "null_profile", "describe_numeric", "agg_group_median", "agg_corr_matrix",
    "agg_boxplot_stats", "agg_roc_auc", "agg_segment_drilldown", "win_group_count", "win_contiguous_folds",
    "win_label_codes", "impute_group_median", "bin_quantile", "encode_dummies", "split_shuffle_repeated",
    "str_extract_title", "rule_tree", "rule_population_fitness", "score_submission", "pipe_basic", "pipe_advanced",
    "pipe_first_layer", "pipe_comparison", "pipe_munge", "model_gaussian_nb", "model_knn", "model_decision_tree",
    "ens_oof_predictions", "ens_vote_hard",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["profile_shape"].run(spark, folder).collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
