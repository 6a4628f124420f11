"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = ["layer_catalogue", "source_stats", "shape_id", "metadata_checks", "check_package", "api_record",
            "metadata_fingerprint", "detect_changes", "upsert_catalog", "catalog_rollup_counts", "latest_status",
            "status_grid", "hash_mod", "dissolve_measures", "shared_borders", "bbox_join", "point_in_boundary",
            "overlap_join", "validity_report", "dissolve", "simplify"]


def main() -> None:
    from pyspark.sql import SparkSession
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("boundaryspark-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from boundaryspark.plans import all_queries
    times: dict[str, float] = {}
    spark.range(1).count()
    for name in HEADLINE:
        start = time.perf_counter()
        all_queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
