"""Append-only audit log and stage-run table.

Entries are JSON lines partitioned by UTC day; ``details`` is a JSON text.
Reading uses a fixed schema and drops malformed lines.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()), T.StructField("actor", T.StringType()),
    T.StructField("event", T.StringType()), T.StructField("details", T.StringType()),
    T.StructField("system", T.StringType()), T.StructField("version", T.StringType()),
])
REQUIRED = ["timestamp", "actor", "event", "details", "system"]
SYSTEM, VERSION = "trialframe", "1.0"


def audit_append(spark: SparkSession, root: str, event: str, details: dict,
                 actor: str = "pipeline", at: datetime | None = None) -> None:
    """Append one entry to the day's partition."""
    at = at or datetime.now(timezone.utc)
    ts = at.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    row = [(ts, actor, event, json.dumps(details, sort_keys=True), SYSTEM, VERSION, at.strftime("%Y%m%d"))]
    df = spark.createDataFrame(row, T.StructType(AUDIT_SCHEMA.fields + [T.StructField("day", T.StringType())]))
    df.coalesce(1).write.mode("append").partitionBy("day").json(root)


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """Parse all days with a fixed schema; malformed lines are dropped."""
    return spark.read.schema(AUDIT_SCHEMA).option("mode", "DROPMALFORMED").json(root)


def event_counts(audit: DataFrame) -> DataFrame:
    """L1: entries per event, most frequent first."""
    return audit.groupBy("event").agg(F.count(F.lit(1)).cast("long").alias("count")).orderBy(
        F.desc("count"), "event")


def completeness(audit: DataFrame) -> DataFrame:
    """L2: entries missing a required field (one row per bad entry, with the missing names)."""
    miss = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]))
    return audit.withColumn("missing", miss).filter(F.size("missing") > 0)


def recent_entries(audit: DataFrame, n: int = 10) -> DataFrame:
    """K4: the n newest entries."""
    return audit.orderBy(F.desc("timestamp"), F.desc("event")).limit(n)


def stage_table(spark: SparkSession, results: list[tuple[str, str, float, str | None]]) -> DataFrame:
    """(stage, status, duration_s, error) of a pipeline run."""
    return spark.createDataFrame(results, "stage string, status string, duration_s double, error string")


def run_summary(stages: DataFrame, expected: int) -> DataFrame:
    """All stages passed only if every row is SUCCESS or RESUMED **and** all expected stages ran."""
    return stages.agg(F.count(F.lit(1)).alias("ran"), F.sum("duration_s").alias("total_s"),
                      F.coalesce(F.bool_and(F.col("status").isin("SUCCESS", "RESUMED")), F.lit(False)).alias("ok")) \
        .withColumn("all_passed", F.col("ok") & (F.col("ran") == expected)).drop("ok")
