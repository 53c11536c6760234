"""Event-time operators, sources and sinks for Structured Streaming."""

from tripmill.streaming.compaction import Version, compact, current_base, newest_version
from tripmill.streaming.eventtime import (
    closed_windows,
    end_of_input,
    sessions,
    tumbling,
    unparsed_times,
    with_event_time,
)
from tripmill.streaming.held import held_sessions, held_windows
from tripmill.streaming.progress import ProgressLog, late_rows, observed
from tripmill.streaming.sinks import (
    append_sink,
    dead_letter_sink,
    read_appended,
    read_upserted,
    run,
    upsert_sink,
)
from tripmill.streaming.sources import read_topic, running_counts, stream_trips

__all__ = [
    "ProgressLog",
    "Version",
    "append_sink",
    "closed_windows",
    "compact",
    "current_base",
    "dead_letter_sink",
    "end_of_input",
    "held_sessions",
    "held_windows",
    "late_rows",
    "newest_version",
    "observed",
    "read_appended",
    "read_topic",
    "read_upserted",
    "run",
    "running_counts",
    "sessions",
    "stream_trips",
    "tumbling",
    "unparsed_times",
    "upsert_sink",
    "with_event_time",
]
