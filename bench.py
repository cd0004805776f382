"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from tessella import get_spark
from tessella.catalogue import QUERIES
from tessella.session import cleanup

HEADLINE = [
    "clean_text",
    "dedupe_keep_first",
    "labelled_postings",
    "tagged_postings",
    "taxonomy_features",
    "rate_by_group",
    "skill_frequencies",
    "tokenize",
    "vocabulary",
    "tfidf",
    "per_group_tfidf",
    "retrieve_topk",
    "answer_questions",
    "skill_gap",
    "confusion_matrix",
    "roc_auc_ovr",
    "stratified_folds",
    "skill_loo",
    "skill_prediction",
    "fit_naive_bayes",
    "fit_logreg",
    "fit_linear_svm",
    "cross_validate",
    "echo_robustness",
    "analyse_postings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tessella-bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's reader and writer once, so the first query is not charged for it.
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        cleanup(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
