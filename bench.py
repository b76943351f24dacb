"""Benchmark: run the analytics queries (or the named ones, corpus operators included) at one scale factor and time them.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected on the driver).  One JSON line is printed:
{"metric": "total_query_seconds", "value": ..., "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.catalog import QUERIES as CORE  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main(argv):
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    import importlib

    QUERIES = importlib.import_module("__spark_entry__").queries()
    names = argv or list(CORE)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, extra={
        "spark.driver.memory": "16g",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
        **({"spark.driver.extraJavaOptions": os.environ["BENCH_JAVA_OPTS"]} if os.environ.get("BENCH_JAVA_OPTS") else {}),
    })
    # warm the JVM (class loading, codegen caches) outside the timed section
    QUERIES["sessions_anomalies"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main(sys.argv[1:])
