"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder with the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from parvis.session import with_defaults  # noqa: E402

HEADLINE = [
    "valuation",
    "dedup_log",
    "fuzzy_pairs",
    "exact_dedup_log",
    "extract_address",
    "comparables",
    "market_quantiles",
    "market_trend",
    "statistical_value",
    "quantile_model",
    "valuation_forest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        with_defaults(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/part.parquet").count()
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
