"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from reviewlake.session import build_session  # noqa: E402
from verification.queries import all_queries  # noqa: E402

HEADLINE = (
    "silver_clean",
    "silver_dedup",
    "quality_suite_silver",
    "mart_sentiment_daily",
    "fct_review_predictions",
    "daily_summary",
    "predict_batch",
    "local_contributions",
    "tfidf_words",
    "char_ngrams",
    "input_drift",
    "chrono_halves",
    "stratified_fold_numbers",
    "threshold_search",
    "roc_auc",
    "incremental_new_rows",
    "endpoint_latency",
    "load_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    chosen = sys.argv[1:] or HEADLINE
    for name in ("mart_sentiment_daily", "chrono_halves"):  # warm up the JVM
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in chosen:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
