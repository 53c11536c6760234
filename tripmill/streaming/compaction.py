"""Stream tables whose batches are folded into one base, so that files do not pile up.

Beside the folders of its batches (see ``sinks``) a table has ``_versions``: a data folder per version and,
for each, a small file ``<number>.json`` that names the folder and the last batch of each stream that it
holds. The newest readable mark is the table's state: creating it is the switch. A compaction that dies
before leaves a folder that nobody reads; one that dies after has only its cleaning left.

A version lasts until the next but one, and the batches it holds until the next, so readers that began
before a switch go on undisturbed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.storage import child_names, create_new, exists, read_text, remove

WRITTEN = "_written_at"
#: What a version says of the origin of each row.
ORIGIN = ("stream", "batch_id")


@dataclass(frozen=True)
class Version:
    """A state of a table: its base, and per stream the last batch that the base holds."""

    number: int = 0
    folder: str | None = None
    folded: dict[str, int] = field(default_factory=dict)

    def holds(self, stream: str, batch_id: int) -> bool:
        return batch_id <= self.folded.get(stream, -1)


def _versions(path: str) -> str:
    return f"{path.rstrip('/')}/_versions"


def _marks(spark: SparkSession, path: str) -> list[int]:
    names = child_names(spark, _versions(path))
    return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def _version(spark: SparkSession, path: str, number: int) -> Version | None:
    try:
        said = json.loads(read_text(spark, f"{_versions(path)}/{number}.json"))
    except ValueError:  # its writer died before it had written the mark
        return None
    return Version(number, f"{_versions(path)}/{said['folder']}", said["folded"])


def newest_version(spark: SparkSession, path: str) -> Version:
    """The table's state; number 0 and no base if it was never compacted."""
    for number in _marks(spark, path):
        found = _version(spark, path, number)
        if found:
            return found
    return Version()


def current_base(spark: SparkSession, path: str) -> str:
    """The folder of the newest base: plain Parquet, with keys one row per key, for any reader."""
    folder = newest_version(spark, path).folder
    if folder is None:
        raise FileNotFoundError(f"{path} has not been compacted yet")
    return folder


def _batches(spark: SparkSession, path: str) -> list[tuple[str, int, str]]:
    """(stream, batch, folder) of all batches whose write has ended."""
    found = []
    for stream in child_names(spark, path):
        if not stream.startswith("stream="):
            continue
        for batch in child_names(spark, f"{path.rstrip('/')}/{stream}"):
            folder = f"{path.rstrip('/')}/{stream}/{batch}"
            if batch.startswith("batch_id=") and exists(spark, f"{folder}/_SUCCESS"):
                found.append((stream[7:], int(batch[9:]), folder))
    return found


def _rows(spark: SparkSession, path: str, version: Version, folders: Sequence[str]) -> DataFrame:
    """Base and batches as one frame, each row with its stream and batch."""
    if version.folder is None and not folders:
        return spark.read.parquet(path)  # no table: Spark's own error
    parts = []
    if version.folder is not None:
        parts.append(spark.read.parquet(version.folder))
    if folders:
        rows = spark.read.option("basePath", path).parquet(*folders)
        parts.append(rows.withColumns({"stream": F.col("stream").cast("string"), "batch_id": F.col("batch_id").cast("bigint")}))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def _first(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    frame = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(frame)).filter("_rank = 1").drop("_rank")


def newest_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key; without keys the newest of all.

    Within a stream a later batch is newer, whatever clock its driver had; between streams the time
    of writing decides. Each task keeps one row per key and stream before the shuffle.
    """
    rows = _first(rows, [*keys, "stream"], [F.desc("batch_id")])
    between = [F.desc(WRITTEN), F.asc("stream")]
    return _first(rows, keys, between) if keys else rows.orderBy(*between).limit(1)


def read_table(spark: SparkSession, path: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Base and later batches as they are now; with ``keys`` (or none of them: ``[]``) resolved, else all rows."""
    version = newest_version(spark, path)
    folders = [f for stream, batch, f in _batches(spark, path) if not version.holds(stream, batch)]
    rows = _rows(spark, path, version, folders)
    rows = rows if keys is None else newest_rows(rows, keys)
    return rows.drop(WRITTEN, *ORIGIN)


def compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] | None = None,
    files: int | None = None,
) -> Version:
    """Fold all batches written so far into a new base; with ``keys`` one row per key, else all rows.

    The stream may run on meanwhile: batches that it ends later stay beside the base. A batch that the
    engine repeats after it was folded has the same rows, and is not read again. Without new batches the
    table stays as it is. Of two compactions at a time, one fails and changes nothing. Files are as
    large as adaptive execution's advisory size, or ``files`` in number.
    """
    now = newest_version(spark, path)
    todo = [b for b in _batches(spark, path) if not now.holds(b[0], b[1])]
    if not todo:
        _clean(spark, path, now)
        return now
    rows = _rows(spark, path, now, [f for _, _, f in todo])
    rows = rows if keys is None else newest_rows(rows, keys)
    number = max([now.number, *_marks(spark, path)]) + 1
    name = f"data-{number}-{uuid.uuid4().hex[:12]}"
    (rows.repartition(files) if files else rows.hint("rebalance")).write.parquet(f"{_versions(path)}/{name}")
    folded = dict(now.folded)
    for stream, batch, _ in todo:
        folded[stream] = max(batch, folded.get(stream, -1))
    create_new(spark, f"{_versions(path)}/{number}.json", json.dumps({"folder": name, "folded": folded}))
    made = Version(number, f"{_versions(path)}/{name}", folded)
    _clean(spark, path, made)
    return made


def _clean(spark: SparkSession, path: str, now: Version) -> None:
    """Remove what neither the newest state nor the one before it needs."""
    before = next((v for n in _marks(spark, path) if n < now.number and (v := _version(spark, path, n))), Version())
    keep = {now.number, before.number}
    folders = {v.folder.rsplit("/", 1)[1] for v in (now, before) if v.folder}
    for name in child_names(spark, _versions(path)):
        number = name[:-5] if name.endswith(".json") else name.split("-")[1]
        # A higher number is another compaction at work.
        if int(number) <= now.number and name not in folders and not (name.endswith(".json") and int(number) in keep):
            remove(spark, f"{_versions(path)}/{name}")
    for stream, batch, folder in _batches(spark, path):
        if before.holds(stream, batch):
            remove(spark, folder)
