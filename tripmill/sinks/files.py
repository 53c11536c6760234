"""Files, messages and relational tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import year_month
from tripmill.storage import remove

MONTH = "year_month"


def write_n_files(df: DataFrame, path: str, n: int) -> None:
    """Overwrite ``path`` with ``n`` files of nearly equal row counts; rows of a task keep their order.

    A file is one task's work, and that task must get its share of all rows. So all tasks deal their rows in turn to
    ``n`` folders of compressed columns beside ``path``, and each folder is read by one task: fewer bytes than rows take in
    a shuffle, which orders them by a hash too.
    """
    spark, dealt, part = df.sparkSession, f"{path.rstrip('/')}-dealt-{uuid.uuid4().hex[:12]}", f"part_{uuid.uuid4().hex[:12]}"
    # A task's numbers begin at its own number, so that short tasks don't all begin with the first folder.
    turn = F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(n)).cast("int")
    try:
        df.withColumn(part, turn).write.option("compression", "zstd").partitionBy(part).parquet(dealt)
        whole = spark.read.schema(T.StructType([*df.schema]).add(part, T.IntegerType())).parquet(dealt)
        shares = [whole.where(F.col(part) == k).drop(part).coalesce(1) for k in range(n)]
        # Shares of one partition each would else be joined to a single one.
        with _setting(spark, "spark.sql.unionOutputPartitioning", "false"):
            reduce(DataFrame.unionAll, shares).write.mode("overwrite").parquet(path)
    finally:
        remove(spark, dealt)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_chunks(df: DataFrame, path: str, rows: int = 100_000, mode: str = "overwrite") -> None:
    """Write files of at most ``rows`` rows, each task on its own."""
    df.write.mode(mode).option("maxRecordsPerFile", rows).parquet(path)


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Number, average and total size of the Parquet files below ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("length")
    )
    megabytes = F.col("length") / (1024 * 1024)
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.round(F.avg(megabytes), 1).alias("avg_mb"),
        F.sum("length").alias("bytes"),
    )


def with_month(df: DataFrame, month_of: str) -> DataFrame:
    return df.withColumn(MONTH, year_month(month_of))


def by_month(df: DataFrame) -> DataFrame:
    """Rows of a month together, in as many tasks as its size asks for.

    The rebalance hint lets adaptive execution split a month that is too big for one task and join
    small ones, so one hot month neither becomes one slow task nor leaves hundreds of tiny files.
    """
    return df.hint("rebalance", MONTH)


def write_layout(
    df: DataFrame, path: str, month_of: str, sort_by: Sequence[str], mode: str = "overwrite"
) -> None:
    """Parquet in one folder per month of ``month_of``, clustered by ``sort_by``.

    Rows are dealt to tasks by ranges of month and sort columns, from bounds that Spark samples, and sorted inside.
    Files of one month therefore hold ranges that meet at their ends at most: a filter on the month
    opens few folders, one on the first sort columns few files of these, and statistics of row groups and
    pages skip the rest. Rows of one sort key are parted too if they are too many, by a hash of the row. The number of
    ranges is the session's number of shuffle partitions; adaptive execution joins small ones.
    """
    rows = with_month(df, month_of)
    parted = rows.repartitionByRange(MONTH, *sort_by, F.xxhash64(*df.columns))
    parted.sortWithinPartitions(MONTH, *sort_by).write.mode(mode).partitionBy(MONTH).parquet(path)


def write_day(df: DataFrame, root: str, day: date | str | int) -> str:
    """One output per run day; a second run of the day replaces the first."""
    path = f"{root.rstrip('/')}/output_day={day}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_snapshot(
    df: DataFrame, root: str, table: str, name: str = "data", at: datetime | None = None
) -> str:
    """Append to the table of the snapshot ``name_<time>``; snapshots sort by name in order of time."""
    at = at or datetime.now(timezone.utc)
    # Two runs in one second are two snapshots.
    path = f"{root.rstrip('/')}/{name}_{at:%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:6]}/{table}"
    df.write.mode("append").parquet(path)
    return path


def publish_json(
    messages: DataFrame, path: str | None = None, kafka: Mapping[str, str] | None = None
) -> None:
    """Send the column ``value`` to a topic (``kafka`` options) or as JSON lines to a folder.

    The topic form needs the connector package on the cluster.
    """
    if kafka:
        messages.select("value").write.format("kafka").options(**kafka).save()
    else:
        messages.select("value").write.mode("append").text(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    batch_rows: int = 100_000,
    connections: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Replace a relational table by an empty one of the frame's schema and append all rows.

    Tasks append in parallel in batches; ``connections`` bounds how many write at once. A small
    dimension is written with ``connections=1``. A task that is run again may append twice, as the
    database offers no commit over all tasks.
    """
    options = {"batchsize": str(batch_rows), **(properties or {})}
    if connections:
        options["numPartitions"] = str(connections)
    df.write.mode(mode).options(**options).jdbc(url, table)
