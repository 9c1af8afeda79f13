"""Benchmark the headline queries.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8).  Each query is executed to completion through the ``noop``
sink (no driver transfer); the time includes any small sizing actions the
operator runs while building its plan.  Before timing, every headline query
runs once, untimed, on the smallest scale factor next to BENCH_SF_DIR
(JVM class loading and JIT warm-up only; no result is reused).  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "count_by_category_sentiment",
    "bias_report",
    "balanced_reviews",
    "word_count_describe",
    "stratified_split",
    "nb_predictions",
    "count_by_category_sentiment_orders",
    "bias_report_orders",
    "balanced_orders",
    "stratified_split_orders",
    "tokenize_reviews",
    "word_ngrams",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from revlens.session import local_session
    from revlens.plans.queries import QUERIES

    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="revlens-bench", driver_memory="16g")
    # JVM warm-up outside the timed region, on the smallest data set.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in HEADLINE:
        try:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        except Exception:  # noqa: BLE001 - the timed run reports errors
            pass

    times, errors = {}, {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - report, keep timing the rest
            errors[name] = str(exc).splitlines()[0][:300]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    result = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
              "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
              "cpus": cpus}
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
