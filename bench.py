"""Time the headline queries over all their rows and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` other queries than the
headline ones (comma-separated, or ``all``).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from rainledger.session import configure
from workbench.registry import QUERIES

# One query per distinct plan; the rest repeat these with another last step.
HEADLINE = [
    "sales_order_lines",
    "products_staged",
    "sales_summary",
    "sales_performance_fact",
    "sales_summary_offline_orders",
    "category_summary",
    "customer_orders",
    "customers_staged",
    "customer_rfm_raw",
    "customer_rfm_fact",
    "rfm_segment_distribution",
    "rfm_v1_scored",
    "weather_bronze_dedup",
    "dim_date",
    "dim_location",
    "weather_fact",
    "drought_risk",
    "fire_risk",
    "mitigation",
    "gold_drought_by_region",
    "gold_weather_trend",
    "gold_fire_by_region",
    "gold_mitigation",
    "insight_drought_rank",
    "insight_climate_trend",
    "top5_fire",
    "payload_flatten",
    "ingest_requests",
    "landing_json_roundtrip",
    "landing_parquet_roundtrip",
    "ingest_readback",
    "regional_export_parquet",
    "order_line_repeats",
    "detail_null_profile",
    "layer_row_counts",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rainledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.log.level", "ERROR")
    )
    return configure(builder).getOrCreate()


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    begun = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timed(spark, names[0], sf_dir)  # start-up and code generation of a first query are not counted
    seconds = {}
    for name in names:
        seconds[name] = round(timed(spark, name, sf_dir), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    result = {
        "metric": f"total seconds over {len(names)} queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
