"""Headline-query benchmark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query end to end (scan -> binding -> job -> result written
to the no-op sink, so every row is produced) and prints one JSON line. The
title-page rate (theses/s) is the figure comparable with the reference's
~75 theses/s re-parse rate.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from folio import bindings as B  # noqa: E402
from folio.catalog import QUERIES  # noqa: E402
from folio.operators.titlepage import extract_titlepage  # noqa: E402
from folio.session import build_session, new_work_dir  # noqa: E402
from folio.sources import oai_dc  # noqa: E402

HEADLINE = [
    "faculty_summary",         # J18 + J28: title-page extraction and the published summary
    "titlepage_fields",        # J18 over every thesis
    "elect_primary_scored",    # J24 over every file row
    "queue_plan",              # J26: the planning query
    "oai_dc_records",          # J3: XML page parsing
    "metadata_last_non_null",  # J11: three replays folded
    "thesis_keyword_links",    # J14
    "failure_ledger_latest",   # J19 + J20
    "xoai_records",            # J4: rich records
    "html_file_grid",          # J6: item pages
    "people_load",             # J12
    "stream_failure_ledger",   # ST3: stream, bronze and fold
]


def staged_pages(spark, sf_dir):
    path = new_work_dir(spark, "bench-pages")
    B.oai_pages(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    # Warm the JVM once so the first query does not pay for class loading.
    QUERIES["fetch_outcome"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    n_theses = B.doc_text_from_titlepages(spark, sf_dir).count()
    t0 = time.perf_counter()
    extract_titlepage(B.doc_text_from_titlepages(spark, sf_dir)).write.format("noop").mode(
        "overwrite").save()
    tp_sec = time.perf_counter() - t0
    # Parsing alone, from stored pages, without the time that makes them.
    stored = staged_pages(spark, sf_dir)
    t0 = time.perf_counter()
    n_records = oai_dc.parse_oai_dc(stored, fail_on_error=False).agg(
        F.count("title"), F.count("authors"), F.sum(F.size("subjects"))).collect()[0][0]
    parse_sec = time.perf_counter() - t0
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "titlepage_theses_per_sec": round(n_theses / tp_sec, 1),
        "reference_theses_per_sec": 75,
        "stored_pages_records_per_sec": round(n_records / parse_sec, 1),
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
