"""Data checks that return their findings as rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT = "check string, column string, failing_rows bigint, status string"


class QualityError(Exception):
    """A check failed and the caller asked for enforcement."""


@dataclass(frozen=True)
class Rule:
    """One check. ``fails`` says of a column where it fails; unique rules have ``keys`` instead.

    Rules are plain values and may be declared before a session exists.
    """

    check: str
    column: str
    fails: Callable[[Column], Column] | None = None
    keys: tuple[str, ...] = ()


def not_null(c: str) -> Rule:
    return Rule("not_null", c, lambda value: value.isNull())


def positive(c: str) -> Rule:
    """Greater than zero; NULL passes."""
    return Rule("positive", c, lambda value: ~(value > 0))


def accepted_values(c: str, values: Sequence) -> Rule:
    """In the list; NULL passes."""
    return Rule("accepted_values", c, lambda value: ~value.isin(*values))


def unique(*columns: str) -> Rule:
    """Each combination at most once; the surplus rows fail. Rows with a NULL in it pass."""
    return Rule("unique", ",".join(columns), keys=columns)


def _report_row(rule: Rule, failing: Column) -> Column:
    return F.struct(
        F.lit(rule.check).alias("check"),
        F.lit(rule.column).alias("column"),
        failing.cast("bigint").alias("failing_rows"),
        F.when(failing > 0, "fail").otherwise("pass").alias("status"),
    )


def check(df: DataFrame, rules: Sequence[Rule], enforce: bool = False) -> DataFrame:
    """One row per rule: check, column, failing_rows, status.

    All row rules share one aggregation over the frame; each unique rule adds one grouped pass.
    With ``enforce`` the report is computed at once and any failing rule raises.
    """
    parts = []
    rowwise = [r for r in rules if r.fails]
    if rowwise:
        counted = df.agg(
            *[F.count_if(r.fails(F.col(r.column))).alias(f"_{i}") for i, r in enumerate(rowwise)]
        )
        rows = F.array(*[_report_row(r, F.col(f"_{i}")) for i, r in enumerate(rowwise)])
        parts.append(counted.select(F.inline(rows)))
    for rule in (r for r in rules if r.keys):
        surplus = (
            df.dropna(subset=list(rule.keys))
            .groupBy(*rule.keys)
            .agg((F.count(F.lit(1)) - 1).alias("_surplus"))
            .agg(F.coalesce(F.sum("_surplus"), F.lit(0)).alias("_surplus"))
        )
        parts.append(surplus.select(F.inline(F.array(_report_row(rule, F.col("_surplus"))))))
    if not parts:
        return df.sparkSession.createDataFrame([], REPORT)
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    if enforce:
        rows = report.collect()  # as many rows as rules
        found = [r for r in rows if r.status == "fail"]
        if found:
            what = ", ".join(f"{r.check}({r.column}): {r.failing_rows}" for r in found)
            raise QualityError(what)
        return df.sparkSession.createDataFrame(rows, report.schema)
    return report


def freshness(
    df: DataFrame,
    c: str,
    as_of: datetime | str,
    warn_after: timedelta = timedelta(hours=24),
    error_after: timedelta = timedelta(hours=48),
) -> DataFrame:
    """Age of the newest ``c`` at ``as_of``: pass, warn or error. An empty source is an error."""
    now = F.lit(str(as_of)).cast("timestamp_ntz")
    newest = F.col("newest")
    return df.agg(F.max(c).cast("timestamp_ntz").alias("newest")).select(
        "newest",
        F.timestamp_diff("SECOND", newest, now).alias("age_seconds"),
        F.when(newest.isNull() | (newest < now - F.lit(error_after)), "error")
        .when(newest < now - F.lit(warn_after), "warn")
        .otherwise("pass")
        .alias("status"),
    )


def check_schema(df: DataFrame, schema: T.StructType, enforce: bool = False) -> DataFrame:
    """Compare names and types with a declared schema; one row per declared or surplus column."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in schema.fields}
    rows = []
    for name in [*wanted, *(n for n in found if n not in wanted)]:
        if name not in found:
            status = "missing"
        elif name not in wanted:
            status = "surplus"
        else:
            status = "pass" if found[name] == wanted[name] else "type"
        rows.append((name, wanted.get(name), found.get(name), status))
    bad = [r for r in rows if r[3] in ("missing", "type")]
    if enforce and bad:
        raise QualityError("; ".join(f"{n}: wanted {w}, found {f}" for n, w, f, _ in bad))
    return df.sparkSession.createDataFrame(
        rows, "column string, declared string, found string, status string"
    )
