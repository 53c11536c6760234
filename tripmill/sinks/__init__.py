"""Writers."""

from tripmill.sinks.convert import convert_months
from tripmill.sinks.files import (
    file_stats,
    publish_json,
    write_chunks,
    write_day,
    write_jdbc,
    write_layout,
    write_n_files,
    write_snapshot,
)
from tripmill.sinks.journal import recover
from tripmill.sinks.materialize import (
    materialize,
    read_months,
    replace_interval,
    replace_table,
    write_checked,
)

__all__ = [
    "convert_months",
    "file_stats",
    "materialize",
    "publish_json",
    "read_months",
    "recover",
    "replace_interval",
    "replace_table",
    "write_checked",
    "write_chunks",
    "write_day",
    "write_jdbc",
    "write_layout",
    "write_n_files",
    "write_snapshot",
]
