"""Times the headline queries and prints one JSON line.

Each query is built and run to the no-op sink: twice to warm up, then three times; the median
counts. BENCH_SF_DIR and BENCH_CPUS choose the data and the cores.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from starfeed.registry import QUERIES  # noqa: E402

HEADLINE = [
    "fact_pedidos",
    "fact_pedidos_incremental",
    "join_left_fanout",
    "join_inner_using",
    "dim_clientes",
    "dim_fecha",
    "dim_ubicaciones",
    "dim_pedidos_delivery",
    "anti_new_customers",
    "anti_nonunique_key",
    "high_water_mark",
    "latest_by_key",
    "json_parse",
    "json_malformed",
    "src_csv_roundtrip",
    "stream_locations",
    "stream_upsert",
    "full_load_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starfeed-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="starfeed-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(5):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[2:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
