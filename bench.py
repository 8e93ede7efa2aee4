"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
tables and the number of local cores. Every query reads the raw tables by itself;
nothing is cached between queries.
"""

from __future__ import annotations

import json
import os
import time

from conformance.registry import QUERIES
from ratingloom.session import build_session

HEADLINE = (
    "clean_catalog",
    "quality_report",
    "yearly_report",
    "genre_report",
    "price_band_report",
    "price_band_exact",
    "top_reliable",
    "platform_report",
    "publisher_report",
    "top_tags",
    "top_tags_wide",
    "era_champions",
    "run_summary",
    "uncertainty_sample",
    "explode_genres",
    "curated_roundtrip",
    "full_run_reports",
)


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    seconds(QUERIES["yearly_report"], spark, sf_dir)  # start-up is not part of any query
    times = {name: round(seconds(QUERIES[name], spark, sf_dir), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
