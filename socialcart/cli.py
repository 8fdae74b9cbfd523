"""Command line: the source project's workflow as Spark jobs.

    python -m socialcart.cli clean     RAW_DIR CLEAN_DIR
    python -m socialcart.cli load      CLEAN_DIR MODEL_DIR
    python -m socialcart.cli analyze   MODEL_DIR OUT_DIR
    python -m socialcart.cli benchmark MODEL_DIR OUT_DIR [--runs N]

``analyze`` writes one result folder per query (rows + summary JSON) and a
summary table; ``benchmark`` times N runs per query, writes the timing CSV
and prints average / sample standard deviation per query.  Run it through
``spark-submit`` on a cluster; the session keeps the submitted settings.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from socialcart.plans import campaigns as q1
from socialcart.plans import recommend as q2
from socialcart.plans import search as q3
from socialcart.plans import stats as B
from socialcart.plans.load import build_relational, read_cleaned, read_tables, write_tables
from socialcart.session import build_session
from socialcart.sources import csv_io, results


def analyses(t: dict) -> dict:
    """The three analyses over the typed tables (relational forms)."""
    def _q1():
        return q1.campaign_conversion(t["messages"], t["campaigns"], t["friends"])

    def _q2():
        return q2.recommendations(t["events"], t["friends"], t["products"])

    def _q3():
        return q3.token_search(q3.keywords(_q2(), t["products"]), t["products"])

    return {"q1": _q1, "q2": _q2, "q3": _q3}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="socialcart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("clean", "load", "analyze", "benchmark"):
        p = sub.add_parser(name)
        p.add_argument("src")
        p.add_argument("dst")
        if name == "benchmark":
            p.add_argument("--runs", type=int, default=5)
    a = ap.parse_args(argv)
    spark: SparkSession = build_session()
    if a.cmd == "clean":
        csv_io.clean_csv_tree(spark, a.src, a.dst).show(truncate=False)
    elif a.cmd == "load":
        write_tables(build_relational(read_cleaned(spark, a.src)), a.dst)
    elif a.cmd == "analyze":
        metas = [results.write_result(fn(), f"{a.dst}/{name}", name)
                 for name, fn in analyses(read_tables(spark, a.src)).items()]
        results.result_summary(spark, [f"{a.dst}/{m['query']}/summary" for m in metas],
                               ["spark"], [m["query"] for m in metas]) \
            .coalesce(1).write.mode("overwrite").option("header", True).csv(f"{a.dst}/summary")
    else:
        rows = []
        for name, fn in analyses(read_tables(spark, a.src)).items():
            for run in range(1, a.runs + 1):
                spark.catalog.clearCache()
                t0 = time.perf_counter()
                fn().write.format("noop").mode("overwrite").save()
                rows.append((name, run, (time.perf_counter() - t0) * 1000.0, "spark"))
        timings = results.write_timings(spark, rows, f"{a.dst}/timings")
        B.timing_stats(timings).orderBy("query_name").show(truncate=False)


if __name__ == "__main__":
    main()
    SparkSession.builder.getOrCreate().stop()
