"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from gridledger.plans.registry import all_queries
from gridledger.session import get_spark

HEADLINE = [
    "volume_by_frequency", "volume_by_variable_top20", "volume_by_experiment_table", "volume_matrix", "volume_unique",
    "best_grid", "slice_merge", "experiment_variables", "mip_variables", "links_bad_by_attr", "inverse_refs", "backlink_counts",
    "wide_table", "priority_min", "revision_diff", "update_violations", "quantiles_by_day", "quantiles_in_ranges", "box_by_day",
    "latest_dataset", "nested_sets", "grid_cells", "nearest_point", "clean_text",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().write.format("noop").mode("overwrite").save()   # warm up
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = folder.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline queries, wall time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
