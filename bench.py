"""Times the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query is run to the end into a sink that discards the rows; the time includes all
jobs and writes that its construction starts. The better of two runs counts. Queries of the
model run once and have a total of their own.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tagloom.catalog import queries  # noqa: E402
from tagloom.session import local_session  # noqa: E402

HEADLINE = (
    "landing_posts",
    "conform_posts",
    "csv_roundtrip",
    "null_counts",
    "describe_posts",
    "posts_with_type",
    "question_posts",
    "clean_text_train",
    "clean_text_infer",
    "training_corpus",
    "distinct_tags",
    "filtered_tokens",
    "term_frequency",
    "idf_weights",
    "label_index",
    "train_test_split",
    "eval_metrics",
    "merge_predictions",
    "labeled_questions",
    "as_of_predictions",
    "users_dim",
    "topic_totals",
    "topic_trend",
    "top10_topics_daily",
    "engagement_by_topic",
    "topic_drilldown",
)
# The model, reported apart: the first of these fits it, the others use that fit.
MODEL = (
    "train_topic_model",
    "infer_topics",
    "eval_topic_model",
    "tokens",
    "hashing_tf",
    "decode_labels",
    "class_metrics",
)
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    model_names = () if sys.argv[1:] else MODEL
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    known = queries()
    known["topic_totals"](spark, folder).collect()

    def run(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {name: round(min(run(name) for _ in range(RUNS)), 3) for name in names}
    model = {name: round(run(name), 3) for name in model_names}
    result = {
        "metric": "headline queries, better of two runs, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "model_queries": model,
        "model_value": round(sum(model.values()), 3),
        "sf": folder.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
