"""Running extract of denied and failed calls from the audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine.sources.audit import parse_audit

ALERT_EVENTS = ("denied", "error")


def alerts(entries: DataFrame) -> DataFrame:
    """Denied and error entries of a static or streaming log."""
    return entries.filter(F.col("event").isin(*ALERT_EVENTS))


def audit_stream(spark: SparkSession, path: str) -> DataFrame:
    """New audit entries as they are appended; malformed lines are skipped."""
    return parse_audit(spark.readStream.text(path))


def start_tail(entries: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append alerts to a Parquet sink, each exactly once."""
    return (alerts(entries).writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())


