"""Prints one JSON line with the seconds each headline query takes, median of three runs.

``messages_*`` queries read messages written beforehand, so they time the operators alone; the
others start from the driver tables and include making the messages.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom import extract_json, flatten_paths
from workload import payloads, queries

CPUS = os.environ.get("BENCH_CPUS", "8")
SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
END_TO_END = ("extract_props", "flatten_lines", "flatten_stack", "flatten_documents", "path_map_rows")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(query: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    query().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stored(spark: SparkSession, df: DataFrame, folder: str) -> DataFrame:
    df.repartition(int(CPUS)).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def operator_queries(spark: SparkSession, folder: str) -> dict[str, tuple[int, Callable[[], DataFrame]]]:
    """Operators over stored messages: name -> (records, query)."""
    orders = stored(spark, payloads.order_messages(spark, SF_DIR), f"{folder}/orders")
    flat = stored(spark, payloads.flat_order_messages(spark, SF_DIR), f"{folder}/flat")
    documents = stored(spark, payloads.document_messages(spark, SF_DIR), f"{folder}/documents")
    events = stored(spark, payloads.event_messages(spark, SF_DIR), f"{folder}/events")
    keys, sales = queries.KEYS, queries.SALES_FIELDS
    nulls = stored(spark, orders.withColumn("value", F.regexp_replace("value", "[}]$", ',"Z":null}')), f"{folder}/nulls")
    tests = {
        "messages_extract": (events, lambda: extract_json(events, queries.PROPS_SCHEMA, queries.PROPS_MAPPING)),
        "messages_lines": (orders, lambda: flatten_paths(orders, sales, keep=keys)),
        "messages_lines_nulls": (nulls, lambda: flatten_paths(nulls, sales, keep=keys)),
        "messages_lines_variant": (orders, lambda: flatten_paths(orders, sales, keep=keys, strategy="variant")),
        "messages_siblings": (orders, lambda: flatten_paths(orders, sales, keep=keys, mode="siblings")),
        "messages_flat_keys": (flat, lambda: flatten_paths(flat, sales, keep=keys, layout="flat")),
        "messages_documents": (documents, lambda: flatten_paths(documents, queries.DOCUMENT_FIELDS, keep=["doc_id"])),
    }
    return {name: (df.count(), query) for name, (df, query) in tests.items()}


def main() -> None:
    spark = session()
    tests = {n: (None, lambda n=n: queries.QUERIES[n](spark, SF_DIR)) for n in END_TO_END}
    tests |= operator_queries(spark, tempfile.mkdtemp(prefix="bench-"))
    times, rates = {}, {}
    for name, (records, query) in tests.items():
        seconds(query)
        times[name] = round(statistics.median(seconds(query) for _ in range(RUNS)), 3)
        if records:
            rates[name] = round(records / times[name])
    report = {
        "metric": "headline queries, total of medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "records_per_sec": rates,
        "sf": SF_DIR.rsplit("sf", 1)[-1].rstrip("/"),
        "cpus": int(CPUS),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
