"""Time every registered query, computed in full and discarded; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from archivetables import ship_package
from workload import tables
from workload.queries import QUERIES


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    spark.range(1000).selectExpr("sum(id)").collect()

    def timed(action):
        begin = time.perf_counter()
        action()
        return round(time.perf_counter() - begin, 3)

    setup = {
        "pack_archives": timed(lambda: tables.archives(spark, sf_dir)),
        "write_sitemap_docs": timed(lambda: tables.sitemap_docs(spark, sf_dir)),
    }
    seconds = {}
    for name in sys.argv[1:] or QUERIES:
        seconds[name] = timed(
            lambda query=QUERIES[name]: query(spark, sf_dir)
            .write.format("noop")
            .mode("overwrite")
            .save()
        )
    result = {
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "setup": setup,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
