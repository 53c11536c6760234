"""Row-wise steps: renames, casts, coercion, messages, samples, unions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import duration_hours, message_time, number, parse_time
from tripmill.schemas import FHV_SOURCES, FHV_STAGED, NORMAL_TRIPS, TIME_COLUMNS


def _lower_names(df: DataFrame) -> dict[str, str]:
    return {name.lower(): name for name in df.columns}


def _cast(column: Column, kind: T.DataType, strict: bool) -> Column:
    return column.cast(kind) if strict else column.try_cast(kind)


def keep(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """The columns of ``schema`` in its order and types; a column the frame lacks is a typed NULL."""
    have = _lower_names(df)
    return df.select(
        *[
            _cast(
                F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None),
                f.dataType,
                strict,
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def with_duration(df: DataFrame, start: str, end: str, name: str = "duration_hours") -> DataFrame:
    return df.withColumn(name, duration_hours(start, end))


def normalize_trips(
    df: DataFrame,
    kind: str,
    renames: Mapping[str, str] | None = None,
    schema: T.StructType = NORMAL_TRIPS,
    strict: bool = True,
) -> DataFrame:
    """Bring one kind of trips to the common names, order and types, and note the kind.

    ``renames`` maps raw to common names. By default the two time columns are those of the kind
    (an unknown kind has the yellow ones) and the location columns the published ones.
    """
    if renames is None:
        pickup, dropoff = TIME_COLUMNS.get(kind, TIME_COLUMNS["yellow"])
        renames = {
            pickup: "pickup_datetime",
            dropoff: "dropoff_datetime",
            "PULocationID": "pickup_location_id",
            "DOLocationID": "dropoff_location_id",
        }
    renamed = df.withColumnsRenamed(dict(renames))
    return keep(with_constant(renamed, "taxi_type", kind), schema, strict)


def stage(
    df: DataFrame,
    schema: T.StructType = FHV_STAGED,
    sources: Mapping[str, str] = FHV_SOURCES,
    require: Sequence[str] = ("dispatching_base_num",),
    strict: bool = True,
) -> DataFrame:
    """Staging model: drop rows without the ``require`` columns, rename and cast the rest.

    ``sources`` maps staged to raw names; ``require`` has raw names. Raw names are matched without
    regard to case. One Project over one Filter, so both reach the scan.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in require], F.lit(True))
    return df.filter(present).select(
        *[
            _cast(F.col(sources.get(f.name, f.name)), f.dataType, strict).alias(f.name)
            for f in schema.fields
        ]
    )


def coerce(
    df: DataFrame,
    times: Iterable[str] = (),
    numbers: Iterable[str] = (),
    drop_null_in: Sequence[str] = (),
    fill_zero: Iterable[str] = (),
    time_format: str | None = None,
) -> DataFrame:
    """Lenient typing: unreadable times and numbers become NULL (NaN too), then rows are dropped, then
    NULLs filled, in that order."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    typed: dict[str, Column] = {}
    for c in times:
        is_text = isinstance(kinds[c], T.StringType)
        typed[c] = parse_time(c, time_format if is_text else None)
    for c in numbers:
        if isinstance(kinds[c], T.StringType):
            typed[c] = number(c)
        else:
            value = F.col(c).cast("double")
            typed[c] = F.when(~F.isnan(value), value)
    out = df.withColumns(typed) if typed else df
    if drop_null_in:
        out = out.dropna(subset=list(drop_null_in))
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in fill_zero}
    return out.withColumns(filled) if filled else out


def _message_fields(df, times, ints, doubles, zero_if_null, texts):
    fields: dict[str, Column] = {}
    must: list[Column] = []
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for c in times:
        fields[c] = message_time(c)
        must.append(fields[c].isNotNull())
    for c in ints:
        missing = F.col(c).isNull()
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(F.col(c))
        value = F.col(c).try_cast("int")
        if c in zero_if_null:
            value = F.when(missing, F.lit(0)).otherwise(value)
        fields[c] = value
        must.append(value.isNotNull())
    for c in doubles:
        fields[c] = F.col(c).cast("double")
    for c in texts:
        fields[c] = F.col(c).cast("string")
    return fields, reduce(lambda a, b: a & b, must, F.lit(True))


def to_message(
    df: DataFrame,
    times: Sequence[str] = (),
    ints: Sequence[str] = (),
    doubles: Sequence[str] = (),
    zero_if_null: Sequence[str] = (),
    texts: Sequence[str] = (),
) -> DataFrame:
    """One JSON object per row in the column ``value``.

    Times are cut to seconds. A NULL in ``zero_if_null`` counts as 0. Rows with a missing time or a
    missing or unfit integer cannot be sent and are left out; ``unsendable`` returns those.
    """
    fields, sendable = _message_fields(df, times, ints, doubles, zero_if_null, texts)
    return df.filter(sendable).select(
        F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("value")
    )


def unsendable(
    df: DataFrame,
    times: Sequence[str] = (),
    ints: Sequence[str] = (),
    doubles: Sequence[str] = (),
    zero_if_null: Sequence[str] = (),
    texts: Sequence[str] = (),
) -> DataFrame:
    """The rows that ``to_message`` leaves out, unchanged."""
    _, sendable = _message_fields(df, times, ints, doubles, zero_if_null, texts)
    return df.filter(~sendable)


def from_message(
    df: DataFrame, schema: T.StructType, column: str = "value", corrupt: str | None = None
) -> DataFrame:
    """Columns of ``schema`` from one JSON object per row; text or bytes.

    ``corrupt`` names one more column, with the text of a message that does not fit the schema, else NULL.
    A message without any text, such as a tombstone, is NULL in all columns, the corrupt one too.
    """
    text = F.col(column).cast("string")
    if corrupt is None:
        return df.select(F.from_json(text, schema).alias("m")).select("m.*")
    wider = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    return df.select(F.from_json(text, wider, options).alias("m")).select("m.*")


def sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """A random part of the rows; the caller chooses it, never the size. A fraction of 1 is all rows."""
    return df.filter(F.rand(seed) < F.lit(fraction))


def sample_by_key(df: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """The rows of about ``fraction`` of all keys, chosen by a digest of key and seed.

    The choice depends on the values alone: another run, layout or number of tasks takes the same rows, all
    rows of a key or none, and a larger fraction takes these and more. Keys are compared as text, NULL as an empty one.
    """
    text = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    place = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.filter(place < F.lit(float(fraction)) * 4294967296)


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows for display, in ``order`` if given."""
    return (df.orderBy(*order) if order else df).limit(n)


def union_trips(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
