"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8). Every query runs
once to warm up and three times for the clock; its best time counts. Results go to a sink that takes
all rows and stores none. Queries that write a table include the write.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill import operators as op
from tripmill import sinks, streaming
from tripmill.functions import between_months, in_interval
from tripmill.plans import QUERIES
from tripmill.session import build_session, shared_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = 3

HEADLINE = [
    "total_rows",
    "distinct_keys",
    "zero_value_count",
    "distinct_in_interval",
    "day_trip_count",
    "longest_duration",
    "least_frequent_zone",
    "payment_mix",
    "trips_unioned",
    "daily_moving_avg",
    "monthly_zone_revenue",
    "top_zone_of_year",
    "staging_dedup",
    "quality_report",
    "tumbling_counts",
    "session_counts",
    "hourly_tips",
]
# Writes and streams: one timed run each.
HEAVY = ["n_files", "partition_layout", "time_interval_rerun", "month_range_ingest",
         "stream_tumbling", "stream_session", "stream_hourly"]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def clock(work, runs: int = RUNS, warm: bool = True) -> float:
    if warm:
        work()
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        work()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def scanned_bytes(df: DataFrame, path: str) -> int:
    """Bytes of the files below ``path`` that hold the rows of ``df``, that is, that must be opened."""
    files = df.select(F.col("_metadata.file_path").alias("file")).distinct()
    sizes = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    held = sizes.join(files, sizes["path"] == files["file"], "left_semi")
    return held.agg(F.sum("length")).first()[0]


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=CPUS,
        conf={"spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    seconds: dict[str, float] = {}

    for name in HEADLINE:
        seconds[name] = clock(lambda: drain(QUERIES[name](spark, SF_DIR)))
    # The three looks that the baseline records: keyed by user.
    per_user = {
        "tumbling_5min_per_user": lambda: streaming.tumbling(events, "ts", "5 minutes", ["user_id"]),
        "session_5min_per_user": lambda: streaming.sessions(events, "ts", "5 minutes", ["user_id"]),
        "hourly_count": lambda: streaming.tumbling(events, "ts", "1 hour"),
    }
    for name, build in per_user.items():
        seconds[name] = clock(lambda: drain(build()))
    for name in HEAVY:
        seconds[name] = clock(lambda: drain(QUERIES[name](spark, SF_DIR)), runs=1)

    def publish() -> None:
        messages = op.to_message(
            events, times=["ts"], ints=["user_id"], doubles=["value"], texts=["event_type"]
        )
        sinks.publish_json(messages, shared_dir(spark, "topic"))

    seconds["publish"] = clock(publish)

    # What fifteen days hold of the table as it is and of the one by month, in bytes of files.
    layout = shared_dir(spark, "layout")
    sinks.write_layout(lines, layout, "l_shipdate", ["l_suppkey", "l_shipdate"])
    plain = lines.filter(in_interval("l_shipdate", "1998-03-01", "1998-03-15"))
    pruned = spark.read.parquet(layout).filter(
        between_months("l_shipdate", "1998-03-01", "1998-03-15")
    )
    opened = {
        "plain": scanned_bytes(plain, f"{SF_DIR}/lineitem.parquet"),
        "by_month": scanned_bytes(pruned, layout),
    }

    rows = events.count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(SF_DIR.rstrip("/").rsplit("sf", 1)[-1]),
                "cpus": CPUS,
                "published_records_per_sec": round(rows / seconds["publish"]),
                "bytes_of_files_read": opened,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
