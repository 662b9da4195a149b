"""Bench: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query is fully materialised through the ``noop`` sink (no driver
collect); nothing is kept between queries, so every timing includes its own work.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "wholesale_daily_summary",   # M1 slice: extract -> units -> SKU match -> summary
    "retail_extract",            # filtered roll-up with count distinct
    "trim_bulk_override",        # wholesale inventory snapshot + overrides
    "fuzzy_top5",                # band-pruned fuzzy top-k join
    "strict_match",              # top-k + veto rules + tie-break
    "partial_best",              # edible backup (grid partial ratio)
    "sales_pipeline",            # E1 end to end (retail ladder + wholesale) -> daily summary
    "inventory_pipeline",        # E2 end to end incl. diagnostics
    "combined_sales",            # channel union, matched + unmatched
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from planmatch.queries import QUERIES
    from planmatch.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-ckpt-", dir="/tmp"))
    names = sys.argv[1:] or HEADLINE
    times = {}
    # a warm-up that no timing holds: the JVM's and the Python workers' start
    warm = spark.range(1000).selectExpr("cast(id as string) as a")
    from planmatch.functions.similarity import ratio_udf

    warm.groupBy("a").count().select(ratio_udf("a", "a")).write.format("noop").mode("overwrite").save()
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
