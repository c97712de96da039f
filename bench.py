"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query is run to completion into a sink that discards rows. One untimed run of the
main query starts the JVM's compilers; its own timed run comes after.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from parcelwatch.plans.queries import QUERIES

HEADLINE = (
    "process_shipments",
    "status_report",
    "enrich",
    "replay_facts",
    "replay_index",
    "split_batch_response",
    "request_batches",
    "carrier_map",
    "preprocess",
    "stage_counts",
    "apply_indicators",
    "calculated_status",
    "classify_status",
    "clean_tracking_number",
    "days_since_latest_event",
    "tn_snapshot",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run(HEADLINE[0])
    seconds = {name: run(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
