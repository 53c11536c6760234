"""Parquet and CSV files."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JError, Py4JJavaError
from pyarrow.fs import FileSystem
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmill.functions import whole_number
from tripmill.operators.projections import keep, union_trips
from tripmill.schemas import YELLOW_CSV, ZONES

#: Footers that a task of the schema census opens, about.
_FOOTERS = 64
_CSV_TIME = "yyyy-MM-dd HH:mm:ss"


def read_trips(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Parquet files; only ``columns`` are read from disk if given.

    With a declared ``schema`` no footer is opened before the query runs.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(*paths)
    return df.select(*columns) if columns else df


def csv_header(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Column names in the header line of the (first) file."""
    return spark.read.csv(paths if isinstance(paths, str) else list(paths), header=True).columns


def read_trips_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = YELLOW_CSV,
    strict: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Typed CSV, plain or gzip. Columns are found by the names in the header line.

    All files must have the same header, else the read fails; a declared column that is not in it is
    NULL. Whole numbers may be written ``1`` or ``1.0``. A value that does not fit its type fails the
    read, or is NULL if not ``strict``. A gzip file is read by one task; ``partitions`` spreads its
    rows for the work that follows.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    declared = {f.name.lower(): f.dataType for f in schema.fields}
    names = csv_header(spark, paths) or schema.names
    kinds = {n: declared.get(n.lower(), T.StringType()) for n in names}
    whole = [n for n, kind in kinds.items() if isinstance(kind, T.LongType)]
    raw = T.StructType(
        [T.StructField(n, T.StringType() if n in whole else kind) for n, kind in kinds.items()]
    )
    reader = spark.read.schema(raw).options(
        header=True,
        enforceSchema=False,
        timestampNTZFormat=_CSV_TIME,
        mode="FAILFAST" if strict else "PERMISSIVE",
    )
    df = reader.csv(paths).withColumns({n: whole_number(n, strict) for n in whole})
    df = keep(df, schema)
    return df.repartition(partitions) if partitions else df


def read_zones(spark: SparkSession, path: str, raw: bool = False) -> DataFrame:
    """Zone lookup CSV; ``raw`` keeps every column of the file as text."""
    if raw:
        return spark.read.csv(path, header=True)
    return spark.read.csv(path, header=True, schema=ZONES, enforceSchema=False)


def read_csv_inferred(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with types found from the data, which costs one more pass over it.

    All files must have the same header line, else the read fails.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    return spark.read.csv(paths, header=True, inferSchema=True, enforceSchema=False)


# Whole and fractional numbers in order of width, for columns typed differently from file to file.
_WIDTH = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if a in _WIDTH and b in _WIDTH:
        wider = max(a, b, key=_WIDTH.index)
        if isinstance(wider, T.FloatType):  # a float cannot hold every int or long
            return T.DoubleType()
        return wider
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampNTZType()
    text = (T.StringType, *map(type, _WIDTH), T.DecimalType, *times)
    if T.StringType() in (a, b) and isinstance(a, text) and isinstance(b, text):
        return T.StringType()
    raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")


def _parquet(spark: SparkSession, paths: Sequence[str], merge: bool = False) -> DataFrame:
    """Folders of one table; names such as ``year_month=202401`` in the path become columns."""
    parts = paths[0].split("/")
    named = next((i for i, part in enumerate(parts) if "=" in part), None)
    reader = spark.read.option("mergeSchema", merge)
    reader = reader.option("basePath", "/".join(parts[:named])) if named else reader
    return reader.parquet(*paths)


def _condition(error: Exception) -> str:
    """Spark's name of the error, however it was raised."""
    if isinstance(error, PySparkException):
        return error.getCondition() or ""
    cause = error.java_exception
    while cause is not None:
        name = getattr(cause, "getCondition", None)
        try:
            if name is not None and (found := name()):
                return found
        except Py4JError:  # this cause has no condition
            pass
        cause = cause.getCause()
    return ""


def _mergeable(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files in groups whose footers merge, with the merged schema, where tasks can't open the files themselves.

    Each try reads footers in one parallel job. Halves of a list that does not merge are tried again,
    so the number of jobs grows with the number of places where a type changes.
    """
    try:
        return [(_parquet(spark, files, merge=True).schema, list(files))]
    except (PySparkException, Py4JJavaError) as error:  # Spark raises one or the other here
        if len(files) == 1 or not _condition(error).startswith("CANNOT_MERGE"):
            raise
    middle = len(files) // 2
    return _mergeable(spark, files[:middle]) + _mergeable(spark, files[middle:])


def _footers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The Parquet schema of each file as text; null for a file that only Spark's own readers can open."""
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            try:
                system, own = FileSystem.from_uri(quote(path, safe="/:@="))
                file = system.open_input_file(own)
            except (pa.ArrowException, ImportError, OSError):
                found.append(None)
                continue
            with file:
                # The first line names the object, the others are the columns.
                found.append(str(pq.ParquetFile(file).schema).split("\n", 1)[1])
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], ["path", "footer"])


def schema_census(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(footer, path) of Parquet files: the text of each file's schema, its columns' types and order, read in tasks by one job.

    ``footer`` is NULL for files that only Spark's own readers can open, in a store of its own kind or behind its credentials.
    A file that is no Parquet file fails the job. One file in each group of equal footers tells the group's types.
    """
    tasks = max(1, min(-(-len(files) // _FOOTERS), 4 * spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(f,) for f in files], "path string").repartition(tasks)
    return listed.mapInArrow(_footers, "path string, footer string").select("footer", "path")


def _merged(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that Spark merges two columns' types to, None if it refuses them."""
    if a == b:
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType) and a.scale == b.scale:
        return max(a, b, key=lambda kind: kind.precision)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = _merged(a.elementType, b.elementType)
        return element and T.ArrayType(element)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = _merged(a.keyType, b.keyType), _merged(a.valueType, b.valueType)
        return T.MapType(key, value) if key and value else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name.lower(): f for f in a.fields}
        for f in b.fields:
            known = fields.get(f.name.lower(), f)
            kind = _merged(known.dataType, f.dataType)
            if kind is None:
                return None
            fields[f.name.lower()] = T.StructField(known.name, kind)
        return T.StructType(list(fields.values()))
    return None


def _by_footer(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files in groups that merge: one census job, the columns of one file for each distinct footer, a merge per group.

    How many jobs it takes depends on the number of distinct footers, not on the number or the order of the files.
    """
    alike: dict[str | None, list[str]] = {}
    for footer, path in schema_census(spark, files).collect():
        alike.setdefault(footer, []).append(path)
    unknown = alike.pop(None, [])
    groups: list[tuple[T.StructType, list[str]]] = []
    for members in sorted(alike.values()):
        columns = spark.read.parquet(members[0]).schema
        for at, (known, held) in enumerate(groups):
            if both := _merged(known, columns):
                groups[at] = (both, held + members)
                break
        else:
            groups.append((columns, members))
    # Types of folder names follow from all names of a group.
    found = [(_parquet(spark, members, merge=True).schema, sorted(members)) for _, members in groups]
    return found + (_mergeable(spark, sorted(unknown)) if unknown else [])


def _by_schema(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Groups of files that merge, as few as equal schemas allow: a union needs one scan per group.

    Only files below the same table folder share a group.
    """
    tables: dict[str, list[str]] = {}
    for file in files:
        tables.setdefault(file.partition("=")[0] if "=" in file else "", []).append(file)
    groups: dict[tuple[str, str], tuple[T.StructType, list[str]]] = {}
    for name, members in tables.items():
        for schema, part in _by_footer(spark, members):
            groups.setdefault((name, schema.json()), (schema, []))[1].extend(part)
    return list(groups.values())


def read_union_by_name(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All rows of many Parquet paths, columns matched by name, absent ones NULL.

    Footers are merged by one parallel job and the result is one scan. Only if a column has different
    types in different files is that refused; a second job then takes a census of the files' schemas, files are read in
    as many groups as there are mixtures of types, wherever they lie in the list, and the
    column is widened: numbers to a wider number, times to a time. A number beside a text becomes text;
    any other mixture, such as a truth value beside a number, is refused.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:  # Spark raises one or the other here
        if not _condition(error).startswith("CANNOT_MERGE"):
            raise
    # A declared schema keeps Spark from opening a footer to list the files. It lists them as URIs, but reads plain paths.
    files = sorted({unquote(f) for f in spark.read.schema(T.StructType([])).parquet(*paths).inputFiles()})
    groups = _by_schema(spark, files)
    target: dict[str, T.StructField] = {}
    for schema, _ in groups:
        for f in schema.fields:
            known = target.get(f.name.lower(), f)
            kind = _common_type(known.dataType, f.dataType)
            target[f.name.lower()] = T.StructField(known.name, kind)
    common = T.StructType(list(target.values()))
    return union_trips(
        *[keep(_parquet(spark, members, merge=True), common) for _, members in groups]
    )


def load_typed(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """The columns of a narrower declared table; a value out of range fails, or is NULL if not strict."""
    return keep(df, schema, strict)


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A table over files that stay where they are. A table that owns its files is never dropped for it."""
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} exists and is not an external table")
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    return spark.table(name)
