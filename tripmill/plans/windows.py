"""Event-time windows over a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import operators as op
from tripmill import streaming as st
from tripmill.plans.registry import query, table

_COUNT = {"num_trips": ("count", None)}
_TIPS = {"total_tip_amount": ("sum", "value")}


def tumbling_sql(source: str, width: str = "5 minute") -> str:
    return (
        f"SELECT time_bucket(INTERVAL {width}, ts) AS window_start, "
        f"time_bucket(INTERVAL {width}, ts) + INTERVAL {width} AS window_end, "
        f"event_type, count(*) AS num_trips FROM {source} GROUP BY ALL"
    )


def hourly_sql(source: str) -> str:
    return (
        "SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, "
        "time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour AS window_end, "
        f"sum(value) AS total_tip_amount FROM {source} GROUP BY ALL"
    )


def sessions_sql(source: str, gap: str = "5 minute") -> str:
    return f"""
    SELECT min(ts) AS session_start, max(ts) + INTERVAL {gap} AS session_end, event_type,
           count(*) AS num_trips
    FROM (
      SELECT ts, event_type,
             sum(opens) OVER (PARTITION BY event_type ORDER BY ts, event_id
                              ROWS UNBOUNDED PRECEDING) AS session
      FROM (
        SELECT ts, event_type, event_id,
               CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id)
                         <= INTERVAL {gap} THEN 0 ELSE 1 END AS opens
        FROM {source}
      )
    )
    GROUP BY event_type, session
    """


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


@query(tumbling_sql("events"))
def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.tumbling(_events(spark, sf_dir), "ts", "5 minutes", ["event_type"], _COUNT)


@query(
    f"SELECT * FROM ({tumbling_sql('events', '1 hour')}) "
    "ORDER BY num_trips DESC, window_start, event_type LIMIT 3"
)
def busiest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = st.tumbling(_events(spark, sf_dir), "ts", "1 hour", ["event_type"], _COUNT)
    return op.top_n(counts, "num_trips", 3, ["window_start", "event_type"])


@query(sessions_sql("events"))
def session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.sessions(_events(spark, sf_dir), "ts", "5 minutes", ["event_type"], _COUNT)


@query(
    f"SELECT * FROM ({sessions_sql('events', '20 minute')}) "
    "ORDER BY num_trips DESC, session_start, event_type LIMIT 1"
)
def longest_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = st.sessions(_events(spark, sf_dir), "ts", "20 minutes", ["event_type"], _COUNT)
    return op.top_n(found, "num_trips", 1, ["session_start", "event_type"])


@query(
    "SELECT window_start, window_end, round(total_tip_amount, 2) AS total_tip_amount "
    f"FROM ({hourly_sql('events')})"
)
def hourly_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    tips = st.tumbling(_events(spark, sf_dir), "ts", "1 hour", (), _TIPS)
    return tips.withColumn("total_tip_amount", F.round("total_tip_amount", 2))


@query(
    "SELECT window_start, round(total_tip_amount, 2) AS total_tip_amount "
    f"FROM ({hourly_sql('events')}) ORDER BY round(total_tip_amount, 2) DESC, window_start LIMIT 1"
)
def top_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    tips = hourly_tips(spark, sf_dir).select("window_start", "total_tip_amount")
    return op.top_n(tips, "total_tip_amount", 1, ["window_start"])
