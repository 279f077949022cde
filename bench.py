"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from opinionlake.registry import all_queries
from opinionlake.registry.base import DEAL
from opinionlake.session import build_session

HEADLINE = (
    "volume_by_week", "trend_by_day", "volume_zero_filled_week", "clean_text", "top_tokens", "top_bigrams", "processed_text",
    "sentiment_scores", "sentiment_distribution", "source_comparison", "token_score", "aspect_summary", "aspect_cowords",
    "aspect_snippets", "governance_row", "run_summary", "dedup_first", "price_quantiles", "cap_outliers", "cap_outliers_global",
    "length_histogram", "detect_language", "page_links", "page_records", "silver_posts", "insert_ignore", "stream_weekly_volume",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # text tables are single row groups here: their rows are dealt out to all cores
    spark = build_session("bench", cores=cpus, **{DEAL: cpus})
    spark.sparkContext.setLogLevel("ERROR")
    found = all_queries()
    # one untimed query starts the JVM code paths and the Python workers
    found["clean_text"].run(spark, sf_dir).limit(10).collect()
    times: dict[str, float] = {}
    for name in HEADLINE:
        begun = time.perf_counter()
        found[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begun, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
