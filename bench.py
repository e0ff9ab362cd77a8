"""Wall time of the registered queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores; BENCH_QUERIES (comma-separated) narrows the list. Each query runs
once to warm up code generation and then once for the record. Results are fully computed and thrown away (noop
sink), so no column is pruned by the measurement. Building the DataFrame is part of the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reelcheck.registry import QUERIES  # noqa: E402
from reelspark.session import local_session  # noqa: E402

HEADLINE = [
    "top_revenue",
    "roi_leaderboard",
    "genre_profitability",
    "star_power_roi",
    "language_distribution",
    "platform_comparison",
    "genre_share_by_decade",
    "genre_cooccurrence",
    "top_by_genre",
    "top_rated",
    "actor_network",
    "movie_list",
    "movie_detail",
    "overview_kpis",
    "normalize_title",
    "entity_spine",
    "bridge_genres",
    "dedupe_by_key",
    "serial_key",
    "constraint_report",
    "extract_pages",
    "fact_metrics",
    "dim_movie",
    "bridge_cast",
    "quarantine_rows",
    "v_movie_cast",
    "person_detail",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total query wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
