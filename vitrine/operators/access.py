"""Role permissions and views of the audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.sources.audit import entry_class


def tools_of(roles: DataFrame, role: str) -> DataFrame:
    """Tools a role may call."""
    return roles.filter(F.col("role") == role).select("tool").distinct()


def check_calls(calls: DataFrame, roles: DataFrame) -> DataFrame:
    """Mark each (role, tool) call as allowed or not; role tables are short, and
    Spark broadcasts them by their size."""
    known = roles.select("role", "tool").distinct().withColumn("_ok", F.lit(True))
    return calls.join(known, ["role", "tool"], "left").withColumn(
        "allowed", F.coalesce("_ok", F.lit(False))).drop("_ok")


def permitted(calls: DataFrame, roles: DataFrame) -> DataFrame:
    """Only the calls their role allows."""
    return calls.join(roles, ["role", "tool"], "left_semi")


def visible_logs(log: DataFrame, roles: DataFrame, role: str, n: int = 50,
                 order: tuple[str, ...] = ("_timestamp",)) -> DataFrame:
    """Of the newest n entries, those on tools the role may call; the limit comes
    first, so fewer than n may be left."""
    newest = log.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return newest.join(tools_of(roles, role), "tool", "left_semi")


def recent_entries(log: DataFrame, n: int = 50, order: tuple[str, ...] = ("_timestamp",)) -> DataFrame:
    """The newest n entries, newest first, with their display class."""
    newest = log.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return newest.withColumn("class", entry_class(F.col("event")))
