"""Times every registered query and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads, BENCH_RUNS the timed runs per query after
one warm-up (the median counts). Arguments name the queries to run; all by default.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from varve.session import build_session
from workload import REGISTRY


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="varve-bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/shared",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )

    def timed(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in sys.argv[1:] or REGISTRY:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 4)
    spark.stop()
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
