"""SparkSession helpers.

Library code never creates its own session; jobs and tests call
``local_session`` (or use a session the cluster hands them).  The only
setting we add to a cluster session is a checkpoint folder, and only when
the cluster has not named one (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "trialframe", event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    A local session without one gets a fresh scratch folder; on a cluster a missing setting is
    an error, because executors do not share the driver's folders.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="trialframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


SMALL_ROWS = 10_000       # up to so many counted rows a table is broadcast


def small_table(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written and counted; broadcast to its join if it has at most ``SMALL_ROWS`` rows.

    For a row a group joined back to all rows: a sort-merge join would deal the large side by the group, a few
    groups to a few tasks, and the planner avoids a broadcast where most of the small side's partitions are empty.
    """
    table = materialised(df, kind)
    return F.broadcast(table) if table.count() <= SMALL_ROWS else table


def materialised(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it is evaluated once, its readers do not depend on
    its lineage, and the files survive lost executors."""
    path = scratch_path(df.sparkSession, f"{kind}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


PARTS_A_CORE = 4
ROW_GROUP_BYTES = 4 << 20


def dealt(df: DataFrame, kind: str) -> DataFrame:
    """Like ``materialised``, for rows that many short jobs read: small row groups, read back in about ``PARTS_A_CORE`` parts a
    core.  As the files come, a few more parts than cores leave most cores idle in each job's second round.

    The number of parts is a setting of the reading session alone; it shares the context with the caller's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{kind}-{uuid.uuid4().hex}")
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.minPartitionNum", str(PARTS_A_CORE * spark.sparkContext.defaultParallelism))
    return reader.read.schema(df.schema).parquet(path)


def cache_bytes(spark: SparkSession) -> int:
    """Bytes of memory that the executors have for cached rows and for what their tasks hold, at least.

    The status lists the driver beside the executors without naming it, so the largest entry is left out; a local session has one.
    """
    entries, sizes = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator(), []
    while entries.hasNext():
        sizes.append(entries.next()._1())
    return sum(sizes) - (max(sizes) if len(sizes) > 1 else 0)
