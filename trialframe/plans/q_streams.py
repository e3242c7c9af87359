"""Queries run as Structured Streaming jobs (availableNow) over the driver's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.operators.requests import REPEAT_INTERVAL_MIN, request_log
from trialframe.plans.catalog import r6, register, rnd
from trialframe.plans.fixtures import shifted_production
from trialframe.plans.q_drift import _WEEK_SPLIT, _drift_windows_sql
from trialframe.plans.q_events import _ALERTS_SQL, _LOG, _NOTICES_SQL, LOW, _firing_sql, _silence_sql
from trialframe.sources.store import register_model, registry_entry
from trialframe.sources.tables import read_table, trials
from trialframe.streaming.stateful import (
    notice_stream, prediction_counts, retrain_stream, rocksdb_state, silence_stream, sustained_stream)
from trialframe.streaming.streams import (
    changed_windows_writer, drift_slice_writer, fresh_dir, latest_windows, read_stream, run_foreach_batch, run_to_table,
    scoring_batch_writer, slice_counts, table_stream, time_feed, windowed_counts)


@register("stream_counts", """
SELECT * FROM (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
         time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
         event_type, CAST(count(*) AS BIGINT) AS count, ROUND(sum(value), 6) + 0e0 AS value_sum
  FROM events GROUP BY 1, 2, 3) w""")
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + T5 + T9: running totals per hour and event type from a file stream with a 10-minute
    watermark, in update mode: each micro-batch writes the windows that it changed, open ones
    included, and the latest write of a window is its total."""
    src = table_stream(spark, sf_dir, "events")
    out = fresh_dir(spark, "counts_out")
    run_foreach_batch(windowed_counts(src), changed_windows_writer(out), fresh_dir(spark, "counts_ckpt"), mode="update")
    return latest_windows(spark.read.parquet(out)).withColumn("value_sum", r6("value_sum"))


@register("stream_scores")
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T13: lineitem files arrive as a stream, are joined to the static
    dimensions and scored in foreachBatch by the model that the registry names at that moment."""
    from trialframe.plans.q_ml import PREDICTED_AT, trained
    _, _, best, path = trained(spark, sf_dir)
    root = fresh_dir(spark, "registry")
    register_model(spark, root, registry_entry(
        spark, model_name="drug_efficacy_classifier", version="1", model=best, registered_at=PREDICTED_AT,
        model_path=path, qualified_for_production=True))
    li = table_stream(spark, sf_dir, "lineitem")
    t = shifted_production(trials(spark, sf_dir, lineitem=li))
    out = fresh_dir(spark, "scores_out")
    run_foreach_batch(t, scoring_batch_writer(root, out, PREDICTED_AT), fresh_dir(spark, "scores_ckpt"))
    return spark.read.parquet(out)


_WATERMARK = "(SELECT make_timestamp((epoch_ms(max(ts)) - 600000) * 1000) FROM events)"     # after the last row, 10 minutes late
PARTS = 3           # arrivals that the event table is fed in


def _event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table arriving in time order as a stream of several micro-batches."""
    return read_stream(spark, time_feed(read_table(spark, sf_dir, "events"), "ts", PARTS, fresh_dir(spark, "events_in")))


def _run(spark: SparkSession, stream: DataFrame, kind: str) -> DataFrame:
    with rocksdb_state(spark):
        return spark.read.parquet(run_to_table(stream, fresh_dir(spark, f"{kind}_out"), fresh_dir(spark, f"{kind}_ckpt")))


_PIPELINES, _COOLDOWN_S = 8, 21_600


@register("retrain_stream", f"""
WITH RECURSIVE trig AS (SELECT user_id % {_PIPELINES} AS pipeline, event_id AS trigger_id, ts FROM events WHERE event_type = 'error'),
acc AS (
  SELECT pipeline, trigger_id, ts
  FROM (SELECT *, row_number() OVER (PARTITION BY pipeline ORDER BY ts, trigger_id) AS k FROM trig) a0 WHERE k = 1
  UNION ALL
  SELECT n.pipeline, n.trigger_id, n.ts FROM acc, LATERAL (
    SELECT t.pipeline, t.trigger_id, t.ts FROM trig t
    WHERE t.pipeline = acc.pipeline AND epoch_us(t.ts) - epoch_us(acc.ts) >= {_COOLDOWN_S * 1_000_000}
    ORDER BY t.ts, t.trigger_id LIMIT 1) n)
SELECT pipeline, trigger_id, ts, trigger_id IN (SELECT trigger_id FROM acc) AS accepted FROM trig
WHERE ts < (SELECT make_timestamp((epoch_ms(max(ts)) - 600000) * 1000) FROM trig)""")
def retrain_stream_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as retrain triggers of eight pipelines, gated by a keyed cooldown stream; a trigger is
    decided when the watermark has passed it."""
    ev = _event_feed(spark, sf_dir).select((F.col("user_id") % _PIPELINES).alias("pipeline"), F.col("event_id").alias("trigger_id"), "ts",
                                           (F.col("event_type") == "error").alias("retrain"))
    return _run(spark, retrain_stream(ev, _COOLDOWN_S), "retrain")


@register("silence_stream", f"""
WITH {_LOG}
SELECT * FROM ({_silence_sql(LOW)}) g
WHERE (epoch_us(gap_end) // 60000000 + 1) * 60000000 <= epoch_us({_WATERMARK})""")
def silence_stream_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silences that end before the watermark, from a stream of minutes and event-time timers."""
    s = _run(spark, silence_stream(request_log(_event_feed(spark, sf_dir)), LOW), "silence").where("state = 'closed'")
    minutes = (F.unix_micros(F.col("gap_end").cast("timestamp")) - F.unix_micros(F.col("gap_start").cast("timestamp"))) / F.lit(60_000_000.0)
    return s.select("alertname", "gap_start", "gap_end", "firing_from", r6(minutes).alias("gap_minutes"))


_FIRED_SQL = _firing_sql(LOW).rstrip().replace("FROM named)", f"""FROM named WHERE alertname IN ('HighErrorRate', 'HighPredictionLatency')
  AND (end_minute + 1) * 60000000 <= epoch_us({_WATERMARK}))""")


@register("alert_stream", _FIRED_SQL + "\n" + _ALERTS_SQL)
def alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 + W6: firing minutes of the error and latency rules from three chained windowed aggregates."""
    return _run(spark, sustained_stream(request_log(_event_feed(spark, sf_dir)), LOW).drop("ets"), "alerts")


@register("notice_stream", f"SELECT * FROM (\n{_FIRED_SQL}{_NOTICES_SQL}\n) told_ WHERE epoch_us(notice_at) + "
          f"{REPEAT_INTERVAL_MIN * 60_000_000} <= epoch_us({_WATERMARK})")
def notice_stream_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of those alerts, repeated an hour after the last one, by keyed state behind the aggregates."""
    firing = sustained_stream(request_log(_event_feed(spark, sf_dir)), LOW)
    return _run(spark, notice_stream(firing), "notices")


@register("stream_prediction_counts")
def stream_prediction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem files arrive, are scored and counted by prediction and confidence in one query, in update mode."""
    from trialframe.ml.train import load_scorer, score
    from trialframe.plans.q_ml import PREDICTED_AT, trained
    rows = shifted_production(trials(spark, sf_dir, lineitem=table_stream(spark, sf_dir, "lineitem")))
    counts = prediction_counts(score(load_scorer(spark, trained(spark, sf_dir)[3]), rows, PREDICTED_AT))
    out = fresh_dir(spark, "prediction_counts_out")
    run_foreach_batch(counts, changed_windows_writer(out), fresh_dir(spark, "prediction_counts_ckpt"), mode="update")
    last = F.max_by("count", "batch_id").alias("count")
    return spark.read.parquet(out).groupBy("prediction", "confidence").agg(last)


@register("drift_stream", f"""
SELECT * FROM ({_drift_windows_sql("CAST(date_trunc('day', ts) AS TIMESTAMP)", 'slice_start')}) d
WHERE slice_start + INTERVAL 1 DAY <= {_WATERMARK}""")
def drift_stream(spark: SparkSession, sf_dir: str, split: str = _WEEK_SPLIT) -> DataFrame:
    """Each day's events from ``split`` on, tested against those before it once the watermark has passed the day."""
    at = F.lit(split).cast("timestamp_ntz")
    ref = read_table(spark, sf_dir, "events").where(F.col("ts") < at)
    src = _event_feed(spark, sf_dir).where(F.col("ts") >= at)
    out = fresh_dir(spark, "drift_out")
    run_foreach_batch(slice_counts(src, "value", "1 day"), drift_slice_writer(ref, "value", out, fresh_dir(spark, "drift_counts")),
                      fresh_dir(spark, "drift_ckpt"))
    return spark.read.parquet(out).drop("batch_id").withColumns(
        {"ks_statistic": rnd("ks_statistic", 4), "p_value": rnd("p_value", 4)})
