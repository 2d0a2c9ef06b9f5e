"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then timed three times; the median
counts.  A run materialises every output row (noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyarrow.parquet as pq  # noqa: E402

from changeguard.queries import QUERIES  # noqa: E402
from changeguard.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# query -> the table whose rows it works through
HEADLINES = {
    "g10_scan_changes": "events",
    "g10_ungoverned_by_day": "events",
    "g14_custody": "orders",
    "g13_reconcile": "orders",
    "a1_fingerprint": "orders",
    "j12_drift_rows": "orders",
    "j2_upsert_split": "orders",
    "j3_merge_conflicts": "customer",
    "j10_related_counts": "lineitem",
    "k1_chain_entries": "events",
    "k2_verify_chain": "events",
    "g8_hygiene": "orders",
    "g9_readiness": "customer",
    "m2_update": "orders",
    "a7_write_summary": "lineitem",
}


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS), memory="16g")
    seconds, rates = {}, {}
    for name, source in HEADLINES.items():
        run(spark, name)
        seconds[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 4)
        rows = pq.read_metadata(f"{SF_DIR}/{source}.parquet").num_rows
        rates[name] = round(rows / seconds[name])
    print(json.dumps({
        "metric": "sum of warm medians over the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "rows_per_sec": rates, "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cores": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
