"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up and then three times; the median counts. Every run computes
all rows and all columns of its result and drops them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trendloom.plans.catalog import REGISTRY  # noqa: E402
from trendloom.session import build_session  # noqa: E402

HEADLINE = [
    "merge_posts",
    "merge_rows",
    "dedup_prefix",
    "limit_per_query",
    "scan_report",
    "comments_limit",
    "drop_excluded",
    "drop_excluded_long",
    "detect_keyword",
    "detect_keyword_long",
    "build_queries",
    "normalise_counts_video",
    "post_card",
    "video_rows",
    "enrich_authors",
    "progress",
    "max_similarity",
    "similarity_stats",
    "domain_filter_posts",
    "domain_filter_videos",
    "tokenise",
    "vocabulary",
    "tfidf",
    "class_tfidf",
    "topic_keywords",
    "cluster_keywords",
    "coherence_c_v",
    "page_titles",
    "feed_titles",
    "stream_merge",
    "stream_enrich",
    "density_topics",
]
RUNS = 3


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cpus)
    took = {}
    for name in HEADLINE:
        seconds(spark, sf_dir, name)
        took[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(RUNS)), 3)
        print(f"{name}: {took[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
