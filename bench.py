"""Time the headline queries; prints one JSON line."""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "map_tokens", "classify", "origins_p05", "merge_runs", "emit_tokens", "object_stats", "reject_reason",
    "reconstruct", "grammar_errors", "roundtrip", "transitions", "max_repetition",
    "token_counts", "entropy", "vocab", "quality_dirty", "ngram_counts", "sequence_loss",
    "smooth3", "onsets", "min_gap", "tempo", "nearest_distance", "sync_score",
    "place_objects", "admit_objects", "chunk_score", "stitch",
    "candidates", "level_record", "decode", "explode_objects", "latest_by_key", "alert_cooldown",
]


def main() -> None:
    from lanestride.plans.bindings import INPUT_PARTITIONS
    from lanestride.plans.registry import QUERIES
    from lanestride.session import build_session
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(app="bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g", INPUT_PARTITIONS: cpus})  # each table is one row group, which one task would scan
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["token_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
