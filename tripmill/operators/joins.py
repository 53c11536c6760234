"""Lookups.

No hint forces a broadcast of a caller's table: Catalyst compares the dimension's size with
``spark.sql.autoBroadcastJoinThreshold``, adaptive execution looks again at the size it really has, and
above the bound the plan is a sort-merge join whose skewed partitions are split at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schemas import PAYMENT_NAMES

_KEY = "_zone_key"


def _whole(df: DataFrame, key: str) -> Column:
    """A key as a whole number; NULL, and so without a match, if that would change its value."""
    kind = df.schema[key].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.when(df[key] == F.floor(df[key]), df[key]).try_cast("bigint")
    if isinstance(kind, T.StringType):
        number = df[key].try_cast("decimal(38,10)")
        return F.when(number == F.floor(number), number).try_cast("bigint")
    return df[key].try_cast("bigint")


def _dimension(zones: DataFrame, zone_key: str, columns: list[str]) -> DataFrame:
    # A lookup read as text may hold keys such as N/A; those match nothing instead of failing the job.
    return zones.select(_whole(zones, zone_key).alias(_KEY), *columns).filter(
        F.col(_KEY).isNotNull()
    )


def with_zone(
    trips: DataFrame,
    zones: DataFrame,
    key: str,
    zone_key: str = "LocationID",
    zone_name: str | list[str] = "Zone",
) -> DataFrame:
    """Left join of trips with the zone lookup; trips without a match keep NULL."""
    names = [zone_name] if isinstance(zone_name, str) else list(zone_name)
    clash = {n.lower() for n in names} & {c.lower() for c in trips.columns}
    if clash:
        raise ValueError(f"trips already have {', '.join(sorted(clash))}")
    zones = _dimension(zones, zone_key, names)
    return trips.join(zones, _whole(trips, key) == zones[_KEY], "left").drop(_KEY)


def count_by_zone(
    trips: DataFrame,
    zones: DataFrame,
    key: str,
    zone_key: str = "LocationID",
    zone_name: str = "Zone",
    name: str = "trips",
) -> DataFrame:
    """Trips per zone name, as ``with_zone`` and a count would give.

    Trips are counted per key first, so the join handles one row per key and a hot key is one row.
    """
    per_key = trips.groupBy(trips[key].alias("_key")).agg(F.count(F.lit(1)).alias(name))
    return (
        with_zone(per_key, zones, "_key", zone_key, zone_name)
        .groupBy(zone_name)
        .agg(F.sum(name).alias(name))
    )


def with_payment_name(trips: DataFrame, code: str, name: str = "payment_name") -> DataFrame:
    """Left join with the payment lookup, a fixed table of six rows and therefore safe to broadcast."""
    values = ", ".join(f"({number}L, '{text}')" for number, text in PAYMENT_NAMES.items())
    lookup = trips.sparkSession.sql(f"SELECT * FROM VALUES {values} AS names(_code, `{name}`)")
    matched = _whole(trips, code) == lookup["_code"]
    return trips.join(F.broadcast(lookup), matched, "left").drop("_code")
