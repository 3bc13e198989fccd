"""Seconds of the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from terralot.plans import catalog, profile

HEADLINE = [
    "consolidate_lines", "canonical_items", "agg_entity_year_type", "agg_entity_quarter", "agg_grouping_sets", "wide_pivot", "remap_vote", "pip_join_zone", "gps_resolve", "zone_stats",
    "tile_counts", "tile_containment", "viewport_filter", "upper_median", "mvt_roundtrip",
]


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # the session's own start isn't a query's time
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    n = profile.table(spark, folder, "lineitem").count()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "lines_per_sec_consolidate": round(n / seconds["consolidate_lines"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
