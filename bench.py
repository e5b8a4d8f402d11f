"""Headline queries, timed: prints one JSON line.

The adapter's trip stops and stop order are staged before the clock starts, so the figures are those
of the engine. Each query runs once cold; then the median of three warm runs is its figure.
"""

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from checks.adapter import stop_order, trip_stops
from tripgrid import Timetable, timetable_base
from tripgrid.schemas import TRIP_STOPS
from tripgrid.sources import Staging

HEADLINES = {
    "timetable_base": lambda rows, sheet: timetable_base(rows, sheet),
    "stop_service_counts": lambda rows, sheet: Timetable(rows, sheet).stops,
    "trip_ranks": lambda rows, sheet: Timetable(rows, sheet).trips,
    "timetable_rows": lambda rows, sheet: Timetable(rows, sheet).rows,
    "timetable_cells": lambda rows, sheet: Timetable(rows, sheet).timetable_cells,
}
WARM_RUNS = 3


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    with tempfile.TemporaryDirectory(prefix="tripgrid-bench-") as shared:
        spark = (
            SparkSession.builder.master(f"local[{cpus}]").appName("tripgrid-bench")
            .config("spark.sql.shuffle.partitions", cpus)
            .config("spark.driver.memory", "16g")
            .config("spark.ui.enabled", "false")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.checkpoint.dir", f"file://{shared}")
            .getOrCreate()
        )
        spark.sparkContext.setLogLevel("ERROR")
        staging = Staging(spark)
        # As many files as tasks: the given table is one row group, which one task would read.
        rows = staging.table(trip_stops(spark, sf_dir).select(*TRIP_STOPS).repartition(int(cpus)), "trip_stops")
        sheet = stop_order(spark, sf_dir)
        cold, warm = {}, {}
        for name, query in HEADLINES.items():
            taken = []
            for _ in range(1 + WARM_RUNS):
                start = time.perf_counter()
                query(rows, sheet).write.format("noop").mode("overwrite").save()
                taken.append(time.perf_counter() - start)
            cold[name], warm[name] = round(taken[0], 3), round(statistics.median(taken[1:]), 3)
        spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "cold": cold, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
