"""Times every query on the tables of $BENCH_SF_DIR and prints one JSON line.

Each query is planned and run to completion into a sink that discards the rows: twice to
warm up, then $BENCH_RUNS times. The value per query is the median, the total their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from sparktally.plans.queries import QUERIES
from sparktally.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def main(names: list[str]) -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        int(CPUS) if CPUS.isdigit() else 8,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times, spread = {}, {}
    for name in names or QUERIES:
        runs = [seconds(name) for _ in range(2 + RUNS)]
        times[name] = round(statistics.median(runs[2:]), 4)
        spread[name] = [round(min(runs[2:]), 4), round(max(runs[2:]), 4)]
    result = {
        "metric": "sum of the median seconds of all queries",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "min_max": spread,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "runs": RUNS,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
