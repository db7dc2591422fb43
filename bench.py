"""Times the registered queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import QUERIES  # noqa: E402
from playlens.session import build_session  # noqa: E402

RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or list(QUERIES)
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in chosen:
        timed(name)  # warm-up
        seconds[name] = round(statistics.median(timed(name) for _ in range(RUNS)), 4)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus), "shuffle_partitions": int(cpus), "spark": spark.version,
        "runs": RUNS}))


if __name__ == "__main__":
    main()
