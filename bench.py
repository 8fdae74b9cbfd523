"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query once to warm up, then ``BENCH_RUNS`` (default 5)
timed runs that execute the whole plan and fetch the result; reports the
median per query and their sum as ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from socialcart.registry import queries  # noqa: E402
from socialcart.session import build_session, checkpoint_root  # noqa: E402
from socialcart.sources import csv_io  # noqa: E402
from socialcart.sources import testviews as tv  # noqa: E402

# the source project's query set (relational forms); the total covers these
HEADLINE = {
    "q1": "q1_campaign_conversion",
    "q2": "q2_recommendations",
    "q3": "q3_token_search",
}
# reported separately, not in the total
EXTRA = {
    "q1_graph": "q1_graph",
    "doc_search": "doc_token_search",
}


def _time_clean(spark, sf_dir: str, runs: int) -> float:
    """Ingest path: a dirty message extract (derived from the orders table)
    written once as CSV, then cleaned to Parquet per run (read, clean,
    metrics, write)."""
    scratch = f"{checkpoint_root(spark)}/bench-{uuid.uuid4().hex}"
    tv.raw_messages(spark, sf_dir).write.option("header", True).csv(f"{scratch}/raw.csv")
    times = []
    for i in range(runs):
        t0 = time.perf_counter()
        csv_io.clean_csv(spark, f"{scratch}/raw.csv", f"{scratch}/clean{i}")
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    reg = queries()
    rows: dict[str, int] = {}

    def timed(names: dict[str, str]) -> dict[str, float]:
        res = {}
        for short, name in names.items():
            fn = reg[name]
            rows[short] = len(fn(spark, sf_dir).collect())  # warm-up
            times = []
            for _ in range(runs):
                spark.catalog.clearCache()  # nothing persisted by one run serves the next
                t0 = time.perf_counter()
                fn(spark, sf_dir).collect()
                times.append(time.perf_counter() - t0)
            res[short] = round(statistics.median(times), 3)
        return res

    out = timed(HEADLINE)
    extra = timed(EXTRA)
    extra["csv_clean"] = _time_clean(spark, sf_dir, runs)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "extra": extra,
        "rows": rows,
        "sf": sf,
        "runs": runs,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
