"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is evaluated completely into Spark's ``noop`` sink. The time of a query includes
building and optimizing its plan; the session is started and warmed up beforehand.
"""

from __future__ import annotations

import json
import os
import re
import time

from checks import jobs
from checks.jobs import QUERIES
from redactory.session import local_session

HEADLINE = (
    "findings",
    "anonymize_documents",
    "entities_in_documents",
    "findings_deny_list",
    "findings_by_language",
    "findings_url",
    "anonymize_table",
    "anonymize_overlapping",
    "findings_place_join",
    "findings_optional_entities",
    "report_totals",
    "anonymize_database_report",
    "observed_report",
    "upsert_latest",
    "page_scan",
    "stream_anonymize",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="bench")
    jobs.SPREAD = True  # each table is one small file here
    queries = dict(QUERIES)
    queries["entities_in_documents"] = lambda s, d: QUERIES["findings"](s, d).groupBy("entity").count()
    for name in ("findings", "upsert_latest"):  # warm-up: class loading and JIT
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    chars = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("sum(octet_length(text)) AS n").first()["n"]
    people = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
                "cpus": cpus,
                "documents_mb_per_second": round(chars / 1e6 / seconds["anonymize_documents"], 2),
                "people_rows_per_second": round(people / seconds["anonymize_table"], 1),
            }
        )
    )


if __name__ == "__main__":
    main()
