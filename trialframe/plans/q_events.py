"""Queries over the request log (the driver's ``events`` re-aimed as serving requests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.operators.cooldown import apply_cooldown
from trialframe.operators.requests import (
    ERROR_RATE_LIMIT, LATENCY_BOUNDS, LATENCY_P99_LIMIT, REPEAT_INTERVAL_MIN, SEVERITY, Limits, counters, exact_quantiles,
    firing_alerts, group_notices, histogram_quantile, latency_histogram, rates, recent, request_log, silences)
from trialframe.plans.catalog import r6, register
from trialframe.sources.tables import read_table

_LOG = """log AS (SELECT ts, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
                  value / 250e0 AS latency_s, event_id FROM events)"""
_LE = ", ".join(f"count(*) FILTER (WHERE latency_s <= {b}e0) AS le_{i}" for i, b in enumerate(LATENCY_BOUNDS))
_MIN = f"""minute AS (SELECT CAST(floor(epoch_us(ts) / 60000000e0) AS BIGINT) AS minute,
                  count(*) AS requests, count(*) FILTER (WHERE status = 500) AS errors,
                  count(*) FILTER (WHERE status <> 500) AS predictions, {_LE}
           FROM log GROUP BY 1)"""
_SUMS = ", ".join(["sum(requests) AS requests", "sum(errors) AS errors", "sum(predictions) AS predictions"]
                  + [f"sum(le_{i}) AS le_{i}" for i in range(len(LATENCY_BOUNDS))])
_WIN = f"""win AS (SELECT end_minute, {_SUMS}
        FROM (SELECT unnest(range(minute, minute + 5)) AS end_minute, * EXCLUDE (minute) FROM minute) x
        GROUP BY end_minute)"""
_CTES = f"WITH {_LOG},\n{_MIN},\n{_WIN}\n"


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_log(read_table(spark, sf_dir, "events"))


def _hq_sql(q: float) -> str:
    parts, prev_c, prev_b = [], "0", "0e0"
    for i, b in enumerate(LATENCY_BOUNDS):
        c = f"le_{i}"
        parts.append(f"WHEN {c} >= {q}e0 * requests THEN {prev_b} + ({b}e0 - {prev_b}) * "
                     f"({q}e0 * requests - {prev_c}) / ({c} - {prev_c})")
        prev_c, prev_b = c, f"{b}e0"
    return f"CASE WHEN requests = 0 THEN NULL {' '.join(parts)} ELSE {LATENCY_BOUNDS[-1]}e0 END"


@register("request_counters", """
SELECT 'POST' AS method, '/predict' AS endpoint, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
       CAST(count(*) AS BIGINT) AS count FROM events GROUP BY 3""")
def request_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + T3: request totals by method, endpoint and status."""
    return counters(_log(spark, sf_dir))


@register("request_rate", _CTES + """
SELECT make_timestamp(end_minute * 60000000) AS window_end, CAST(requests AS BIGINT) AS requests,
       CAST(errors AS BIGINT) AS errors, ROUND(requests / 300e0, 6) + 0e0 AS request_rate,
       ROUND(errors / 300e0, 6) + 0e0 AS error_rate,
       ROUND(predictions / 300e0 * 60e0, 6) + 0e0 AS predictions_per_min,
       errors / 300e0 > """ + str(ERROR_RATE_LIMIT) + """ AS error_rate_high
FROM win""")
def request_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 + T3 + T8 condition: 5-minute sliding rates, one row per minute with traffic."""
    r = rates(_log(spark, sf_dir))
    return r.select("window_end", "requests", "errors", r6("request_rate").alias("request_rate"),
                    r6("error_rate").alias("error_rate"), r6("predictions_per_min").alias("predictions_per_min"),
                    (F.col("error_rate") > ERROR_RATE_LIMIT).alias("error_rate_high"))


@register("latency_histogram", _CTES + "SELECT make_timestamp(end_minute * 60000000) AS window_end, "
          + ", ".join(f"CAST(le_{i} AS BIGINT) AS le_{i}" for i in range(len(LATENCY_BOUNDS)))
          + ", CAST(requests AS BIGINT) AS le_inf FROM win")
def latency_histogram_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: cumulative latency buckets (0.01 ... 2 s, +Inf) over 5-minute sliding windows."""
    return latency_histogram(_log(spark, sf_dir)).drop("end_minute")


@register("latency_quantiles", _CTES + f"""
SELECT make_timestamp(end_minute * 60000000) AS window_end,
  ROUND({_hq_sql(0.5)}, 6) + 0e0 AS p50, ROUND({_hq_sql(0.95)}, 6) + 0e0 AS p95,
  ROUND({_hq_sql(0.99)}, 6) + 0e0 AS p99, COALESCE({_hq_sql(0.99)} > {LATENCY_P99_LIMIT}e0, false) AS p99_high
FROM win""")
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram quantiles p50 / p95 / p99 per window (p99 can never exceed 2 s)."""
    h = latency_histogram(_log(spark, sf_dir))
    return h.select("window_end", r6(histogram_quantile(0.5)).alias("p50"),
                    r6(histogram_quantile(0.95)).alias("p95"), r6(histogram_quantile(0.99)).alias("p99"),
                    F.coalesce(histogram_quantile(0.99) > LATENCY_P99_LIMIT, F.lit(False)).alias("p99_high"))


@register("latency_quantiles_exact", f"""
WITH {_LOG},
x AS (SELECT unnest(range(m, m + 5)) AS end_minute, latency_s
      FROM (SELECT CAST(floor(epoch_us(ts) / 60000000e0) AS BIGINT) AS m, latency_s FROM log WHERE latency_s IS NOT NULL) y),
q AS (SELECT end_minute, count(*) AS n, quantile_cont(latency_s, [0.5, 0.95, 0.99]) AS q FROM x GROUP BY end_minute)
SELECT make_timestamp(end_minute * 60000000) AS window_end, n, ROUND(q[1], 6) + 0e0 AS p50, ROUND(q[2], 6) + 0e0 AS p95,
       ROUND(q[3], 6) + 0e0 AS p99, q[3] > {LATENCY_P99_LIMIT} AS p99_high FROM q""")
def latency_quantiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact p50 / p95 / p99 per 5-minute sliding window from distinct-value counts; p99 may exceed 2 s."""
    x = exact_quantiles(_log(spark, sf_dir), [0.5, 0.95, 0.99])
    return x.select("window_end", "n", r6("q_0").alias("p50"), r6("q_1").alias("p95"), r6("q_2").alias("p99"),
                    (F.col("q_2") > LATENCY_P99_LIMIT).alias("p99_high"))


LOW = Limits(error_rate=0.001, latency_p99=0.35, sustained_min=1, silence_lookback_min=3, silence_for_min=3)


def _gaps_sql(name: str, source: str, need: int) -> str:
    """Gaps between predictions, before the first and after the last (the log's last row is now)."""
    return f"""
        SELECT '{name}' AS alertname, gap_start, gap_end, gap_start + INTERVAL {need} MINUTE AS firing_from,
               ROUND((epoch_us(gap_end) - epoch_us(gap_start)) / 60000000e0, 6) + 0e0 AS gap_minutes
        FROM (SELECT lag(ts) OVER (ORDER BY ts) AS gap_start, ts AS gap_end FROM {source}
              UNION ALL SELECT (SELECT min(ts) FROM log), coalesce((SELECT min(ts) FROM {source}), (SELECT max(ts) FROM log))
              UNION ALL SELECT (SELECT max(ts) FROM {source}), (SELECT max(ts) FROM log)) g
        WHERE epoch_us(gap_end) - epoch_us(gap_start) > {need * 60_000_000}"""


def _silence_sql(limits: Limits) -> str:
    return " UNION ALL ".join([
        _gaps_sql("NoPredictionsReceived", "(SELECT ts FROM log WHERE status <> 500)", limits.silence_lookback_min + limits.silence_for_min),
        _gaps_sql("TrafficGap", "(SELECT ts FROM log)", limits.gap_lookback_min + limits.gap_for_min)])


def _firing_sql(limits: Limits) -> str:
    held = limits.sustained_min + 1
    severity = "CASE alertname " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEVERITY.items()) + " END"
    return _CTES.rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + f""",
err AS (SELECT end_minute FROM win WHERE errors / 300e0 > {limits.error_rate}),
lat AS (SELECT end_minute FROM win WHERE COALESCE({_hq_sql(0.99)} > {limits.latency_p99}e0, false)),
gaps AS ({_silence_sql(limits)}),
named AS (
  SELECT 'HighErrorRate' AS alertname, t AS end_minute
  FROM (SELECT unnest(range(end_minute, end_minute + {held})) AS t FROM err) GROUP BY t HAVING count(*) = {held}
  UNION ALL
  SELECT 'HighPredictionLatency', t
  FROM (SELECT unnest(range(end_minute, end_minute + {held})) AS t FROM lat) GROUP BY t HAVING count(*) = {held}
  UNION ALL
  SELECT DISTINCT alertname, unnest(range(CAST(ceil(epoch_us(firing_from) / 60000000e0) AS BIGINT),
    CAST(ceil(epoch_us(gap_end) / 60000000e0) AS BIGINT))) AS end_minute FROM gaps),
fire AS (SELECT alertname, {severity} AS severity, end_minute FROM named)
"""


_ALERTS_SQL = "SELECT alertname, severity, make_timestamp(end_minute * 60000000) AS window_end FROM fire"
_NOTICES_SQL = f""",
told AS (
  SELECT alertname, severity, min(end_minute) AS at FROM fire GROUP BY 1, 2
  UNION ALL
  SELECT told.alertname, told.severity, n.at FROM told, LATERAL (
    SELECT min(f.end_minute) AS at FROM fire f
    WHERE f.alertname = told.alertname AND f.end_minute >= told.at + {REPEAT_INTERVAL_MIN}) n WHERE n.at IS NOT NULL)
SELECT told.alertname, told.severity, make_timestamp(told.at * 60000000) AS notice_at, CAST(count(*) AS BIGINT) AS firing_minutes
FROM told JOIN fire f ON f.alertname = told.alertname AND f.end_minute >= told.at AND f.end_minute < told.at + {REPEAT_INTERVAL_MIN}
GROUP BY told.alertname, told.severity, told.at"""


@register("sustained_alerts", _firing_sql(Limits()) + _ALERTS_SQL)
def sustained_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 + W6 + T7: firing minutes of all four rules at the serving limits."""
    return firing_alerts(_log(spark, sf_dir)).select("alertname", "severity", "window_end")


@register("sustained_alerts_low", _firing_sql(LOW) + _ALERTS_SQL)
def sustained_alerts_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same at limits that every rule of this log exceeds."""
    return firing_alerts(_log(spark, sf_dir), LOW).select("alertname", "severity", "window_end")


@register("alert_grouping", _firing_sql(Limits()).rstrip() + _NOTICES_SQL)
def alert_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices per (alertname, severity), repeated an hour after the last one."""
    return group_notices(firing_alerts(_log(spark, sf_dir)))


@register("alert_grouping_low", _firing_sql(LOW).rstrip() + _NOTICES_SQL)
def alert_grouping_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_notices(firing_alerts(_log(spark, sf_dir), LOW))


@register("silence_windows", f"WITH {_LOG}\n" + _silence_sql(Limits()))
def silence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps long enough to fire 'no predictions for 30m' / 'no request for 1m', the open one included."""
    return _silences(spark, sf_dir, Limits())


@register("silence_windows_low", f"WITH {_LOG}\n" + _silence_sql(LOW))
def silence_windows_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silences(spark, sf_dir, LOW)


def _silences(spark: SparkSession, sf_dir: str, limits: Limits) -> DataFrame:
    log, out = _log(spark, sf_dir), None
    for name, lookback, held, ok_only in (
            ("NoPredictionsReceived", limits.silence_lookback_min, limits.silence_for_min, True),
            ("TrafficGap", limits.gap_lookback_min, limits.gap_for_min, False)):
        s = silences(log, lookback, held, status_ok=ok_only).select(
            F.lit(name).alias("alertname"), "gap_start", "gap_end", "firing_from", r6("gap_minutes").alias("gap_minutes"))
        out = s if out is None else out.unionByName(s)
    return out


@register("retrain_cooldown", """
WITH RECURSIVE trig AS (SELECT event_id AS trigger_id, ts FROM events WHERE event_type = 'error'),
acc AS (
  SELECT * FROM (SELECT trigger_id, ts FROM trig ORDER BY ts, trigger_id LIMIT 1) a0
  UNION ALL
  SELECT n.trigger_id, n.ts FROM acc, LATERAL (
    SELECT t.trigger_id, t.ts FROM trig t WHERE epoch_us(t.ts) - epoch_us(acc.ts) >= 300000000
    ORDER BY t.ts, t.trigger_id LIMIT 1) n
)
SELECT trigger_id, ts, trigger_id IN (SELECT trigger_id FROM acc) AS accepted FROM trig""")
def retrain_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 + T11: error events as retrain triggers; accepted unless within 300 s of an accepted one."""
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    return apply_cooldown(ev.select(F.col("event_id").alias("trigger_id"), "ts"), 300)


@register("recent_events", """
SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 50""")
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + K4: the 50 newest events (top-k report)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return recent(ev, "ts", 50, ["event_id"])
