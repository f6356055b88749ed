"""Time every registered query: python bench.py prints one JSON line.

BENCH_SF_DIR (folder with the tables), BENCH_CPUS and BENCH_RUNS are read from the environment. Each query
runs once to warm up, then BENCH_RUNS times; the median counts. All result rows are computed and dropped.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from tarmac.plans.queries import QUERIES
from tarmac.session import build_session


def run_once(query, spark, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names or list(QUERIES):
        run_once(QUERIES[name], spark, folder)
        seconds[name] = round(statistics.median(run_once(QUERIES[name], spark, folder) for _ in range(runs)), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
