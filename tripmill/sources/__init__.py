"""Readers."""

from tripmill.sources.files import (
    load_typed,
    read_csv_inferred,
    read_trips,
    read_trips_csv,
    read_union_by_name,
    read_zones,
    register_external,
    schema_census,
)
from tripmill.sources.landed import read_json_pages, read_latest_snapshot
from tripmill.sources.months import ingest_months, month_name, month_path, months_between

__all__ = [
    "ingest_months",
    "load_typed",
    "month_name",
    "month_path",
    "months_between",
    "read_csv_inferred",
    "read_json_pages",
    "read_latest_snapshot",
    "read_trips",
    "read_trips_csv",
    "read_union_by_name",
    "read_zones",
    "register_external",
    "schema_census",
]
