"""Structured Streaming forms.

* ``windowed_counts``: event-time windows with a watermark (T2, T5, T9), either in append mode
  (closed windows only, exactly-once file sink) or in update mode (running totals).
* ``scoring_stream``: arriving lineitem files joined to the static
  dimension tables (stream-static join) and scored in ``foreachBatch`` on the path of the
  batch job, with the scale saved in the model folder; the registry is read
  per micro-batch, so a newly registered model is picked up without a
  restart (T1, T13).
* ``slice_counts`` and ``drift_slice_writer``: value counts of event-time slices are kept in state and each
  closed slice is tested against a fixed reference with the windowed KS plan (T10).
* ``late_account``: rows that the watermark dropped, from the query's progress (T9).

Every query runs with ``trigger(availableNow=True)`` here (process what is
there, then stop); on a cluster the same code runs with a processing-time
trigger.  Checkpoints live under the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.session import scratch_path


def fresh_dir(spark: SparkSession, kind: str) -> str:
    return scratch_path(spark, f"streams/{kind}/{uuid.uuid4().hex}")


def read_stream(spark: SparkSession, directory: str, pattern: str = "*.parquet",
                max_files: int = 1) -> DataFrame:
    """A file stream over ``directory`` (files matching ``pattern``), with the
    schema of the files already there (no inference at run time)."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(directory).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", max_files).parquet(directory))


def windowed_counts(events: DataFrame, window: str = "1 hour", watermark: str = "10 minutes",
                    key: str = "event_type") -> DataFrame:
    """Counts per (event-time window, key); late rows beyond the watermark are dropped.

    ``withWatermark`` needs TIMESTAMP (not TIMESTAMP_NTZ): the session time
    zone is UTC, so the cast keeps the wall-clock value.
    """
    e = events.withColumn("ets", F.col("ts").cast("timestamp"))
    return (e.withWatermark("ets", watermark)
             .groupBy(F.window("ets", window), key)
             .agg(F.count(F.lit(1)).cast("long").alias("count"),
                  F.sum("value").alias("value_sum"))
             .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window.end").cast("timestamp_ntz").alias("window_end"), key, "count", "value_sum"))


def run_to_table(df: DataFrame, out: str, checkpoint: str, mode: str = "append", account: str | None = None) -> str:
    """Run a streaming DataFrame to completion into a Parquet table (file sink, exactly once).

    ``account`` names a table to which the run appends its late-row account."""
    q = (df.writeStream.format("parquet").outputMode(mode).option("path", out)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if account is not None:
        late_account(df.sparkSession, q.recentProgress).write.mode("append").parquet(account)
    return out


def late_account(spark: SparkSession, progress: list) -> DataFrame:
    """(run_id, batch_id, operator, rows_in_state, late_rows) of each stateful operator in each micro-batch of a query's
    progress; ``late_rows`` came after the watermark and were dropped (aggregates count them after partial sums)."""
    rows = [(p["runId"] if isinstance(p["runId"], str) else str(p["runId"]), p["batchId"], i, s["numRowsTotal"], s["numRowsDroppedByWatermark"])
            for p in progress for i, s in enumerate(p["stateOperators"])]
    return spark.createDataFrame(rows, "run_id string, batch_id long, operator int, rows_in_state long, late_rows long")


def time_feed(df: DataFrame, ts: str, parts: int, directory: str) -> str:
    """Write ``df`` as ``parts`` arrivals of equal time spans, oldest first, for a file stream over ``directory``."""
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    if lo is None:
        df.write.parquet(directory)
        return directory
    for i in range(parts):
        span = F.lit(True)
        if i:
            span = span & (F.col(ts) >= F.lit(lo + (hi - lo) * i / parts))
        if i < parts - 1:
            span = span & (F.col(ts) < F.lit(lo + (hi - lo) * (i + 1) / parts))
        df.where(span).coalesce(1).write.mode("append").parquet(directory)
    return directory


def changed_windows_writer(out: str):
    """A foreachBatch function for update mode: the windows that a micro-batch changed (a replayed
    batch overwrites its own partition)."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out))
    return fn


def latest_windows(written: DataFrame, key: str = "event_type") -> DataFrame:
    """Each window's latest totals from what ``changed_windows_writer`` wrote."""
    values = [c for c in written.columns if c not in ("window_start", "window_end", key, "batch_id")]
    last = F.max_by(F.struct(*values), "batch_id").alias("last")
    return written.groupBy("window_start", "window_end", key).agg(last).select("window_start", "window_end", key, "last.*")


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, mode: str = "append") -> None:
    """Run a streaming DataFrame to completion with a ``foreachBatch`` function."""
    q = (df.writeStream.outputMode(mode).foreachBatch(fn).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    q.awaitTermination()


def scoring_batch_writer(root: str, out: str, predicted_at: str):
    """T1 + T13: a foreachBatch function that reads the registry's current entry
    each micro-batch, loads that model with its saved scale, scores the raw rows on the same path as a
    batch (defaults, contract, features, model) and appends the predictions with the batch id
    (idempotent: a replayed batch overwrites its own partition)."""
    from trialframe.ml.train import load_scorer, score
    from trialframe.sources.store import read_registry, current_model

    loaded: dict = {}

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        entry = current_model(read_registry(spark, root)).orderBy(F.desc("registered_at"), F.desc("version")).first()
        if loaded.get("version") != entry["version"]:
            loaded["scorer"] = load_scorer(spark, entry["model_path"])
            loaded["version"] = entry["version"]
        scored = score(loaded["scorer"], batch, predicted_at)
        (scored.withColumn("model_version", F.lit(entry["version"])).withColumn("batch_id", F.lit(batch_id))
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("batch_id").parquet(out))

    return fn


def slice_counts(rows: DataFrame, value: str, window: str, watermark: str = "10 minutes") -> DataFrame:
    """(w, v, n_cur), the value counts of each event-time slice, once the watermark has passed its end."""
    e = rows.select(F.col("ts").cast("timestamp").alias("ets"), F.col(value).cast("double").alias("v")).where("v is not null")
    return (e.withWatermark("ets", watermark).groupBy(F.window("ets", window).alias("slice"), "v")
            .agg(F.count(F.lit(1)).cast("long").alias("n_cur"))
            .select(F.col("slice.start").cast("timestamp_ntz").alias("w"), "v", "n_cur"))


def drift_slice_writer(reference: DataFrame, value: str, out: str, counts_path: str):
    """A foreachBatch function that tests the slices that a micro-batch closed against a fixed reference.

    The counts of a slice are kept in the query's state until it closes, so its verdict does not depend on how the rows
    were cut into micro-batches.  The reference's value counts are written once to ``counts_path``."""
    from trialframe.operators.drift import value_counts, windowed_ks_from_counts

    value_counts(reference, value, "n_ref").write.mode("overwrite").parquet(counts_path)

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, f"{counts_path}-closed/batch={batch_id}"
        batch.write.mode("overwrite").parquet(path)             # a replayed batch overwrites its own
        closed = spark.read.schema(batch.schema).parquet(path)
        if not closed.isEmpty():
            ref = spark.read.parquet(counts_path)
            (windowed_ks_from_counts(ref, closed, "slice_start", places=None).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out))

    return fn


def table_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The driver's one-file table ``<table>.parquet`` as a file stream."""
    return read_stream(spark, sf_dir, f"{table}.parquet")
