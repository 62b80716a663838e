"""Time the headline queries and print one JSON line.

Each query is built and written to the ``noop`` sink, so that all of its rows and columns are worked
out and none are kept. The first of ``BENCH_RUNS`` runs warms up the JVM when there are several; the
best of the others counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from clinflow.plans import REGISTRY  # noqa: E402

HEADLINE = (
    "json_gate",
    "route_types",
    "merged_entity_enrich",
    "message_feed_batch",
    "map_patient",
    "bundle_batch",
    "bundle_explode",
    "identity_target",
    "fetched_messages",
    "fetch_dead_letter",
    "send_time_range",
    "store_scan_job",
    "slice_sizes",
    "export_messages",
    "export_rejects",
    "web_path_columns",
    "study_lookup",
    "study_metadata",
    "imaging_batch",
    "resource_current",
    "resource_search",
    "message_delete",
    "segments_nested",
    "segments_flat",
    "error_window_counts",
    "latency_distribution",
    "form_payloads",
    "guarded_map_rows",
    "stream_message_feed",
    "stream_imaging",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else (
        list(REGISTRY) if os.environ.get("BENCH_ALL") else HEADLINE
    )
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clinflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken[1:] or taken), 3)
    spark.stop()
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
