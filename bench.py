"""Wall-clock per query on the test tables; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads. Every query is planned
and run once to warm up, then BENCH_RUNS times, and the fastest run counts. Results
are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

from earshot.plans.catalog import QUERIES
from earshot.session import session


def _seconds(spark, build, sf_dir: str) -> float:
    started = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = sys.argv[1:] or list(QUERIES)
    spark = session(
        app="bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        build = QUERIES[name]
        _seconds(spark, build, sf_dir)
        seconds[name] = round(min(_seconds(spark, build, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall-clock of all queries, best of runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
