"""Headline batch timings on $BENCH_SF_DIR (default /root/testdata/sf0.1), local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, no collect),
once to warm the JVM and once timed. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "features",             # W2-W5 + P19: as-of features, skew-safe buckets
    "rule_flags",           # P14 + W1: all-match rule evaluation
    "blended_flags",        # P15: rules + model blend
    "decisions",            # P16
    "process_batch",        # T9 batch twin: envelope -> stages -> store -> evaluate
    "claim_ledger",         # T2 fold over the delivery log
    "top_flagged_merchants",
    "feature_export",       # M1
    "temporal_split",       # M4 / W7 scalable global ordinal
    "average_precision",    # M9 via range-partitioned prefix sums
    "ingest_latency",       # A3 exact percentiles without one-task buffers
    "flag_increase",        # A11 sliding windows
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from riskline.plans.catalog import entries
    from riskline.session import local_session

    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    reg = entries()
    times: dict[str, float] = {}
    for key in HEADLINE:
        fn = reg[key].fn
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").count()
    total = round(sum(times.values()), 3)
    out = {
        "metric": "headline_batch_seconds_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "events": events,
        "features_events_per_s": round(events / times["features"], 1) if times["features"] else None,
        "rule_flags_events_per_s": round(events / times["rule_flags"], 1) if times["rule_flags"] else None,
        "process_batch_events_per_s": round(events / times["process_batch"], 1) if times["process_batch"] else None,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
