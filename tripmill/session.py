"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Times carry no zone in the data; one fixed zone keeps the stream boundary exact.
ZONE = {"spark.sql.session.timeZone": "UTC"}

# Settings that jobs of this package run best with, whatever the cluster's size.
PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Size that adaptive execution joins and splits shuffle partitions to; also the size of files
    # written after a rebalance.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Sessions are merged inside each task before the shuffle, so a hot key ships few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Window state lives on disk beside the heap, not in it.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app: str = "tripmill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the package's settings; ``conf`` has the last word.

    ``shuffle_partitions`` is the upper bound that adaptive execution coalesces from. On a cluster
    choose it so that the largest shuffle divided by it stays near 200 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**ZONE, **PREFERRED}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prefer(spark: SparkSession) -> SparkSession:
    """Set what the package prefers on a session built elsewhere, where that left it open."""
    for key, value in PREFERRED.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """``prefer``, and the fixed time zone. All settings may change at run time."""
    for key, value in ZONE.items():
        spark.conf.set(key, value)
    return prefer(spark)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name that every executor can reach.

    The parent is the folder in ``spark.checkpoint.dir``. A cluster must set it; on one machine it
    is by default a folder in the warehouse.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        parent = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{parent.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
