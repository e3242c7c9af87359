"""Request-log metrics and alert rules (T3-T8, T12, W5, W6, K3, K4), batch form.

The serving metrics of the reference (counters, a latency histogram and
PromQL rules over them) are computed from a request log with columns
(ts, status, latency_s).  The plans avoid time-ordered windows over raw
rows, which would funnel a whole time range into one task:

* rows are first pre-aggregated per minute (map-side combine, so a hot
  minute collapses before the shuffle);
* a sliding window of W minutes is built by expanding each minute row into
  the W window ends that contain it, then summing by window end;
* a condition sustained "for" D minutes holds at t when it held at every
  evaluation in [t - D, t]: each true evaluation is expanded forward over D
  and counted per t;
* silences use gaps between consecutive active minutes: lag inside each day
  over at most 1440 minute rows, plus one lag over the per-day table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialframe.operators.cooldown import cover
from trialframe.operators.prefix import running_totals

# Latency histogram upper bounds (seconds) and alert rules.
LATENCY_BOUNDS = [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0]
ERROR_RATE_LIMIT = 0.01          # failed requests per second, over 5 minutes, for 5 minutes
LATENCY_P99_LIMIT = 2.0          # seconds, over 5 minutes, for 5 minutes
SILENCE_LOOKBACK_MIN = 30        # no predictions in 30 minutes ...
SILENCE_FOR_MIN = 30             # ... for 30 minutes
GAP_LOOKBACK_MIN = 1             # no request at all in 1 minute ...
GAP_FOR_MIN = 1                  # ... for 1 minute
REPEAT_INTERVAL_MIN = 60         # an alert group is told again after an hour

QUANTILE_RANGES = 16             # ranges of a window's values in which running counts are taken


def request_log(events: DataFrame) -> DataFrame:
    """Re-aim the driver's ``events`` as a serving log: an ``error`` event is
    a failed request (status 500), every other one a prediction (200);
    latency is ``value / 250`` seconds."""
    return events.select(
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        (F.col("value") / F.lit(250.0)).alias("latency_s"),
        F.lit("POST").alias("method"), F.lit("/predict").alias("endpoint"),
        "event_id")


def minute_of(ts: Column) -> Column:
    """Minutes since the epoch (an integer time bucket)."""
    return F.floor(F.unix_micros(F.to_timestamp(ts)) / F.lit(60_000_000)).cast("long")


def minute_ts(m: Column) -> Column:
    return F.timestamp_micros(m * F.lit(60_000_000)).cast("timestamp_ntz")


def per_minute(log: DataFrame) -> DataFrame:
    """Pre-aggregate: one row per active minute with request, error and
    cumulative latency-bucket counts."""
    lat = F.col("latency_s")
    return log.groupBy(minute_of(F.col("ts")).alias("minute")).agg(
        F.count(F.lit(1)).cast("long").alias("requests"),
        F.count_if(F.col("status") == 500).cast("long").alias("errors"),
        F.count_if(F.col("status") != 500).cast("long").alias("predictions"),
        *[F.count_if(lat <= b).cast("long").alias(f"le_{i}") for i, b in enumerate(LATENCY_BOUNDS)])


def sliding(minutes: DataFrame, width: int, sums: list[str]) -> DataFrame:
    """Sums over windows (end - width, end] in minutes, stepping by 1 minute.

    Each minute row is expanded into the ``width`` window ends containing it;
    only windows with at least one active minute appear.
    """
    ends = F.explode(F.sequence(F.col("minute"), F.col("minute") + F.lit(width - 1))).alias("end_minute")
    x = minutes.select(ends, *sums)
    return x.groupBy("end_minute").agg(*[F.sum(c).cast("long").alias(c) for c in sums])


def counters(log: DataFrame) -> DataFrame:
    """Running totals by (method, endpoint, status)."""
    return log.groupBy("method", "endpoint", "status").agg(F.count(F.lit(1)).cast("long").alias("count"))


def rates(log: DataFrame, width: int = 5) -> DataFrame:
    """T5: per window end, requests/s and failed requests/s over ``width`` minutes."""
    s = sliding(per_minute(log), width, ["requests", "errors", "predictions"])
    sec = float(width * 60)
    return s.select("end_minute", minute_ts(F.col("end_minute")).alias("window_end"),
                    "requests", "errors",
                    (F.col("requests") / F.lit(sec)).alias("request_rate"),
                    (F.col("errors") / F.lit(sec)).alias("error_rate"),
                    (F.col("predictions") / F.lit(sec) * F.lit(60.0)).alias("predictions_per_min"))


def latency_histogram(log: DataFrame, width: int = 5) -> DataFrame:
    """T4: cumulative bucket counts per window (wide: le_0..le_7 and total = +Inf)."""
    cols = [f"le_{i}" for i in range(len(LATENCY_BOUNDS))]
    s = sliding(per_minute(log), width, cols + ["requests"])
    return s.select("end_minute", minute_ts(F.col("end_minute")).alias("window_end"), *cols,
                    F.col("requests").alias("le_inf"))


def histogram_quantile(q: float) -> Column:
    """Quantile from cumulative buckets le_0..le_7, le_inf (Prometheus rule).

    rank = q * total; the first bucket whose cumulative count reaches rank is
    interpolated linearly between its bounds (the first bucket starts at 0);
    when only +Inf reaches it, the largest finite bound is returned.
    """
    total = F.col("le_inf")
    rank = F.lit(q) * total
    expr = F.when(total == 0, F.lit(None).cast("double"))
    prev_c, prev_b = F.lit(0), F.lit(0.0)
    for i, b in enumerate(LATENCY_BOUNDS):
        c = F.col(f"le_{i}")
        inside = prev_b + (F.lit(b) - prev_b) * (rank - prev_c) / (c - prev_c)
        expr = expr.when(c >= rank, inside)
        prev_c, prev_b = c, F.lit(b)
    return expr.otherwise(F.lit(LATENCY_BOUNDS[-1]))


def exact_quantiles(log: DataFrame, qs: list[float], width: int = 5) -> DataFrame:
    """(end_minute, window_end, n, q_0, q_1, ...), the exact latency quantiles of each sliding window.

    Rows are first counted per minute and distinct latency, and only the counts are merged over the ``width`` windows that hold the
    minute.  Running counts over ranges of a window's values give the ranks (linear interpolation between
    neighbours); no window's values are collected.  Null and NaN latencies are ignored.
    """
    v = F.nanvl(F.col("latency_s"), F.lit(None).cast("double"))
    per = (log.select(minute_of(F.col("ts")).alias("minute"), v.alias("v")).where("v is not null")
           .groupBy("minute", "v").agg(F.count(F.lit(1)).cast("long").alias("c")))
    merged = (per.select(F.explode(F.sequence(F.col("minute"), F.col("minute") + F.lit(width - 1))).alias("end_minute"), "v", "c")
              .groupBy("end_minute", "v").agg(F.sum("c").alias("c")))
    ranked = running_totals(merged, "v", ["c"], keys=["end_minute"], buckets=QUANTILE_RANGES)
    sizes = per.groupBy("minute").agg(F.sum("c").alias("n")).select(
        F.explode(F.sequence(F.col("minute"), F.col("minute") + F.lit(width - 1))).alias("end_minute"), "n").groupBy("end_minute").agg(
        F.sum("n").alias("n"))
    rows, n, upto = ranked.join(sizes, "end_minute"), F.col("n"), F.col("cum_c")

    def at(rank):       # the smallest value with more than ``rank`` values up to it
        return F.min(F.when(upto > rank, F.col("v")))

    cols = []
    for i, q in enumerate(qs):
        pos = F.lit(q) * (n - 1)
        cols += [at(F.floor(pos)).alias(f"_a{i}"), at(F.ceil(pos)).alias(f"_b{i}")]
    out = rows.groupBy("end_minute", "n").agg(*cols)
    share = lambda q: F.lit(q) * (n - 1) - F.floor(F.lit(q) * (n - 1))      # noqa: E731
    return out.select("end_minute", minute_ts(F.col("end_minute")).alias("window_end"), n, *[
        (F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * share(q)).alias(f"q_{i}") for i, q in enumerate(qs)])


def sustained(cond: DataFrame, for_minutes: int, key: list[str] | None = None) -> DataFrame:
    """Evaluation minutes t where the condition held at every minute of [t - D, t].

    ``cond`` has (key..., end_minute) rows for minutes where the condition is
    true (absent = false).  Returns (key..., end_minute) of firing minutes.
    """
    key = key or []
    x = cond.select(*key, F.explode(F.sequence(F.col("end_minute"),
                                               F.col("end_minute") + F.lit(for_minutes))).alias("t"))
    return (x.groupBy(*key, "t").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") == for_minutes + 1).select(*key, F.col("t").alias("end_minute")))


@dataclass(frozen=True)
class Limits:
    """Thresholds of the alert rules; the defaults are the serving rules' own."""
    error_rate: float = ERROR_RATE_LIMIT
    latency_p99: float = LATENCY_P99_LIMIT
    sustained_min: int = 5
    silence_lookback_min: int = SILENCE_LOOKBACK_MIN
    silence_for_min: int = SILENCE_FOR_MIN
    gap_lookback_min: int = GAP_LOOKBACK_MIN
    gap_for_min: int = GAP_FOR_MIN


# Severities of the rules.
SEVERITY = {"HighErrorRate": "warning", "HighPredictionLatency": "warning",
            "NoPredictionsReceived": "warning", "TrafficGap": "critical"}


def firing_alerts(log: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(alertname, severity, end_minute, window_end) for every firing minute of all four rules.

    The log has no heartbeat, so "the API is down" is read as a traffic gap: no request at all.
    """
    err = rates(log).filter(F.col("error_rate") > limits.error_rate).select("end_minute")
    lat = latency_histogram(log).filter(histogram_quantile(0.99) > limits.latency_p99).select("end_minute")
    quiet = silences(log, limits.silence_lookback_min, limits.silence_for_min)
    gap = silences(log, limits.gap_lookback_min, limits.gap_for_min, status_ok=False)
    found = {"HighErrorRate": sustained(err, limits.sustained_min), "HighPredictionLatency": sustained(lat, limits.sustained_min),
             "NoPredictionsReceived": firing_minutes(quiet), "TrafficGap": firing_minutes(gap)}
    out = None
    for name, rows in found.items():
        rows = rows.select(F.lit(name).alias("alertname"), F.lit(SEVERITY[name]).alias("severity"), "end_minute")
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("window_end", minute_ts(F.col("end_minute")))


def firing_minutes(gaps: DataFrame) -> DataFrame:
    """(end_minute): the whole minutes from ``firing_from`` to before ``gap_end``."""
    us = lambda c: F.unix_micros(F.to_timestamp(c))     # noqa: E731
    first, last = F.ceil(us("firing_from") / F.lit(60_000_000)), F.ceil(us("gap_end") / F.lit(60_000_000)) - 1
    return (gaps.where(first <= last).select(F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias("end_minute"))
            .distinct())


def group_notices(firing: DataFrame, repeat_min: int = REPEAT_INTERVAL_MIN) -> DataFrame:
    """Notices per (alertname, severity): the first firing minute, and then the next
    firing minute at least ``repeat_min`` after the last notice.  ``firing_minutes`` counts the
    firing minutes that a notice stands for."""
    keys = ["alertname", "severity"]
    instants = firing.select(*keys, (F.col("end_minute") * 60_000_000).alias("_us")).distinct()
    return (cover(instants, repeat_min * 60, keys).groupBy(*keys, "_by").agg(F.count(F.lit(1)).cast("long").alias("firing_minutes"))
            .select(*keys, F.timestamp_micros("_by").cast("timestamp_ntz").alias("notice_at"), "firing_minutes"))


def silences(log: DataFrame, lookback_min: int = SILENCE_LOOKBACK_MIN, for_min: int = SILENCE_FOR_MIN,
             status_ok: bool = True, as_of: Column | None = None) -> DataFrame:
    """Stretches without predictions long enough to fire the silence rule.

    The rule fires at t when no prediction arrived in (t - lookback, t], and
    that has held for ``for_min``: a gap (a, b) between consecutive
    predictions fires from a + lookback + for until b.  The stretch from the log's first row to
    the first prediction and the one from the last prediction to ``as_of`` (default: the log's
    last row) are gaps too.  Gaps are taken between consecutive active minutes (exact
    timestamps kept), so windows run over at most 1440 rows per day plus one row per day.
    """
    pred = log.filter(F.col("status") != 500) if status_ok else log
    m = pred.groupBy(minute_of(F.col("ts")).alias("minute")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    m = m.withColumn("day", F.floor(F.col("minute") / F.lit(1440)).cast("long"))
    w_in = Window.partitionBy("day").orderBy("minute")
    inner = m.withColumn("prev_last", F.lag("last_ts").over(w_in)).filter(F.col("prev_last").isNotNull())
    days = m.groupBy("day").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    cross = days.withColumn("prev_last", F.lag("last_ts").over(Window.orderBy("day"))).filter(
        F.col("prev_last").isNotNull())
    whole = log.agg(F.min("ts").alias("log_first"), F.max("ts").alias("log_last"))
    ends = pred.agg(F.min("ts").alias("pred_first"), F.max("ts").alias("pred_last")).crossJoin(whole)      # one row
    now = F.col("log_last") if as_of is None else as_of.cast("timestamp_ntz")
    span = lambda a, z: F.struct(a.alias("gap_start"), z.alias("gap_end"))      # noqa: E731
    edges = ends.select(F.explode(F.array(span(F.col("log_first"), F.coalesce("pred_first", now)),
                                          span(F.col("pred_last"), now))).alias("g")).select("g.*")
    gaps = inner.select(F.col("prev_last").alias("gap_start"), F.col("first_ts").alias("gap_end")).unionByName(
        cross.select(F.col("prev_last").alias("gap_start"), F.col("first_ts").alias("gap_end"))).unionByName(edges)
    gap_s = F.unix_micros(F.to_timestamp("gap_end")) - F.unix_micros(F.to_timestamp("gap_start"))
    need = (lookback_min + for_min) * 60 * 1_000_000
    return gaps.filter(gap_s > need).select(
        "gap_start", "gap_end",
        (F.col("gap_start") + F.make_dt_interval(mins=F.lit(lookback_min + for_min))).alias("firing_from"),
        (gap_s / F.lit(60_000_000.0)).alias("gap_minutes"))


def recent(df: DataFrame, ts: str, n: int, tiebreak: list[str]) -> DataFrame:
    """K3/K4: the newest n rows (TakeOrderedAndProject: a bounded top-k per task)."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in tiebreak]).limit(n)
