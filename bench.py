"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list, default the headline set).
Each query is built from scratch (parquet scan, corpus, text work, graph)
and run to completion with the ``noop`` sink, so nothing is collected to
the driver. Before timing, every query runs once on the sf0.01 data
next to ``BENCH_SF_DIR`` (if present) so that JIT compilation of the
plans is not counted: the numbers are steady-state, as in a long-running
cluster session. Each query is then timed twice and the faster run counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = [
    "page_features", "word_count", "link_edges", "word_edges", "category_edges", "latest_per_year",
    "xml_round_trip", "pages_first_write_wins", "graph_endpoints", "category_degree",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

    from revgraph.session import get_session
    from revgraph.plans.catalog import QUERIES

    spark = get_session(
        "revgraph-bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": str(max(8, cpus * 2)),
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, where: str = sf_dir) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    for name in names:
        run(name, warm_dir if os.path.isdir(warm_dir) else sf_dir)
    # Best of two runs per query: the host's speed varies between runs.
    times = {name: round(min(run(name), run(name)), 3) for name in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
