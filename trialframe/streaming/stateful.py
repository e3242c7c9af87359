"""Rules that remember: retrain cooldown (T11), silences (T7), sustained alerts (T8, W6) and notices (T12) as streams.

* ``sustained_stream`` chains three windowed aggregates under one watermark, all declarative: minutes,
  sliding windows, and runs of true evaluations.
* The others are ``transformWithState`` processors.  Each decides in order of event time although rows arrive
  in any order: rows wait in list state until the watermark has passed them, an event-time timer
  wakes the key, and the rows up to the watermark are taken in order.  What a key remembers beyond its
  waiting rows is one value.

A row is decided once the watermark has reached its time.  Rows behind the watermark of the micro-batch before are
dropped (see ``late_account``); all others are taken in before anything is decided.  Keys hold few rows by nature (verdicts, firing minutes, active minutes):
raw requests are reduced to minutes before they reach a processor.  State lives in RocksDB under the query's
checkpoint, so a restarted query goes on where the last one ended.
"""

from __future__ import annotations

import contextlib
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trialframe.operators.cooldown import RETRAIN_COOLDOWN_S
from trialframe.operators.requests import (
    LATENCY_BOUNDS, REPEAT_INTERVAL_MIN, SEVERITY, Limits, histogram_quantile)

# the process that prepares a stateful query need not have this package on its path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MINUTE_US = 60_000_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which ``transformWithState`` needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class InOrder(StatefulProcessor):
    """Hands a key's rows to ``step`` in order of event time, each once the watermark has passed it.

    ``row`` names the columns of a waiting row (the first is its time in microseconds), ``memory`` those of the
    remembered value, ``out`` the columns of the output after the key's own.
    """

    row: str
    memory: str
    keys: list[str]
    out: list[str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.row)
        self.remembered = handle.getValueState("remembered", self.memory)
        self.names = [c.split()[0] for c in self.row.split(", ")]

    def step(self, memory: tuple | None, row: tuple) -> tuple[tuple | None, list[tuple]]:
        """The next row in time: what is remembered after it, and output rows."""
        raise NotImplementedError

    def passed(self, memory: tuple | None, until: int) -> tuple[tuple | None, list[tuple], int | None]:
        """All rows up to ``until`` are in: what is remembered, output rows, and when to ask again."""
        return memory, [], None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            plain = pdf[self.names].astype(object).where(pdf[self.names].notna(), None)
            found = [tuple(v.item() if hasattr(v, "item") else v for v in r) for r in plain.itertuples(index=False, name=None)]
            if found:
                self.waiting.appendList([tuple(int(v) if isinstance(v, float) else v for v in r) for r in found])
                earliest = int(min(r[0] for r in found))
                first = earliest if first is None else min(first, earliest)
        if first is not None:
            self.handle.registerTimer(-(-first // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: tuple((v is not None, v) for v in r)) if self.waiting.exists() else []
        ready, later = [r for r in rows if r[0] <= until], [r for r in rows if r[0] > until]
        memory = tuple(self.remembered.get()) if self.remembered.exists() else None
        out: list[tuple] = []
        for r in ready:
            memory, more = self.step(memory, r)
            out += more
        memory, more, again = self.passed(memory, until)
        out += more
        if memory is None:
            self.remembered.clear()
        else:
            self.remembered.update(memory)
        if ready:
            self.waiting.clear()
            if later:
                self.waiting.put(later)
        for at in ([later[0][0]] if later else []) + ([again] if again is not None else []):
            self.handle.registerTimer(-(-at // 1000))       # after the watermark: the timer that fires now is gone afterwards
        if out:
            columns = dict(zip(self.out, zip(*out, strict=True), strict=True))
            yield pd.DataFrame({**{k: [v] * len(out) for k, v in zip(self.keys, key, strict=True)},
                                **{c: pd.Series(v, dtype="Int64" if c.endswith("_us") else None) for c, v in columns.items()}})

    def close(self) -> None:
        pass


class Cooldown(InOrder):
    """A trigger is accepted unless an accepted one is less than the cooldown before it; ties by id."""

    row, memory, keys, out = "us long, trigger_id long", "last long", ["pipeline"], ["us_", "trigger_id", "accepted"]

    def __init__(self, cooldown_s: int):
        self.cool = cooldown_s * 1_000_000

    def step(self, memory, row):
        us, trigger = row
        accepted = memory is None or us - memory[0] >= self.cool
        return ((us,) if accepted else memory), [(us, trigger, accepted)]


class Notices(InOrder):
    """A notice at the first firing minute, and at the next firing minute at least ``repeat`` after the last one; a
    notice comes out when the watermark has passed the stretch that it stands for."""

    row, memory, keys, out = "us long", "notice long, n long, last long", ["alertname", "severity"], ["notice_us", "firing_minutes"]

    def __init__(self, repeat_min: int):
        self.repeat = repeat_min * MINUTE_US

    def step(self, memory, row):
        us, = row
        if memory is None:
            return (us, 1, us), []
        notice, n, last = memory
        if us == last:
            return memory, []
        if us >= notice + self.repeat:
            return (us, 1, us), [(notice, n)]
        return (notice, n + 1, us), []

    def passed(self, memory, until):
        if memory is None:
            return None, [], None
        end = memory[0] + self.repeat
        return (None, [(memory[0], memory[1])], None) if until >= end else (memory, [], end)


class Silence(InOrder):
    """Gaps longer than a rule's ``need_min`` minutes between the active minutes of a rule: ``open`` by timer when nothing has come for that
    long, ``closed`` with its end when something comes."""

    row = "us long, first long, last long"
    memory, keys, out = "start long, told boolean", ["alertname"], ["state", "gap_start_us", "gap_end_us"]

    def __init__(self, need_min: dict[str, int]):
        self.need_min = need_min

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.need = self.need_min[key[0]] * MINUTE_US
        return super().handleExpiredTimer(key, timerValues, expiredTimerInfo)

    def step(self, memory, row):
        us, first, last = row
        start, told = memory or (us, False)
        if first is None:                       # traffic, but none that counts for the rule
            return (start, told), []
        gap = first - start > self.need
        return (last, False), [("closed", start, first)] if gap else []

    def passed(self, memory, until):
        if memory is None:
            return None, [], None
        (start, told), whole = memory, until // MINUTE_US * MINUTE_US        # minutes that are closed
        if told:
            return memory, [], None
        if whole - start > self.need:
            return (start, True), [("open", start, None)], None
        return memory, [], (start + self.need) // MINUTE_US * MINUTE_US + MINUTE_US


def watermarked(rows: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """``ets``, the rows' time as TIMESTAMP with a watermark (the session time zone is UTC)."""
    return rows.withColumn("ets", F.col(ts).cast("timestamp")).withWatermark("ets", delay)


def retrain_stream(verdicts: DataFrame, cooldown_s: int = RETRAIN_COOLDOWN_S, delay: str = "10 minutes") -> DataFrame:
    """A stream of (pipeline, trigger_id, ts, retrain) -> (pipeline, trigger_id, ts, accepted) for the verdicts that ask
    for a retrain, as ``apply_cooldown`` decides them for each pipeline (the watermark follows these verdicts)."""
    asked = watermarked(verdicts.where("retrain"), delay).select(
        "ets", "pipeline", "trigger_id", F.unix_micros("ets").alias("us"))
    kind = verdicts.schema["pipeline"].dataType.simpleString()
    out = asked.groupBy("pipeline").transformWithStateInPandas(
        Cooldown(cooldown_s), f"pipeline {kind}, us_ long, trigger_id long, accepted boolean", "append", "eventTime")
    return out.select("pipeline", "trigger_id", F.timestamp_micros("us_").cast("timestamp_ntz").alias("ts"), "accepted")


def minute_stream(log: DataFrame, delay: str) -> DataFrame:
    """One row per active minute, when the watermark has passed it; ``ets`` carries the watermark on."""
    ok = F.col("status") != 500
    return (watermarked(log, delay).groupBy(F.window("ets", "1 minute").alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"), F.count_if(~ok).alias("errors"),
                 F.min("ets").alias("first"), F.max("ets").alias("last"),
                 F.min(F.when(ok, F.col("ets"))).alias("ok_first"), F.max(F.when(ok, F.col("ets"))).alias("ok_last"),
                 *[F.count_if(F.col("latency_s") <= b).alias(f"le_{i}") for i, b in enumerate(LATENCY_BOUNDS)])
            .select(F.window_time("w").alias("ets"), "*").drop("w"))


def silence_stream(log: DataFrame, limits: Limits = Limits(), delay: str = "10 minutes") -> DataFrame:
    """(alertname, state, gap_start, gap_end, firing_from) of the two silence rules.

    ``closed`` rows are those of ``silences``; an ``open`` row comes before, from a timer, when the
    watermark passes the moment at which the rule fires and nothing has come.
    """
    us = F.unix_micros
    span = lambda a, z: [us(F.col("first")).alias("us"), us(F.col(a)).alias("first"), us(F.col(z)).alias("last")]       # noqa: E731
    minutes = minute_stream(log, delay)
    rules = F.array(*[F.struct(F.lit(name).alias("alertname"), *span(a, z)) for name, a, z in (
        ("NoPredictionsReceived", "ok_first", "ok_last"), ("TrafficGap", "first", "last"))])
    rows = minutes.select("ets", F.explode(rules).alias("r")).select("ets", "r.*")
    need = {"NoPredictionsReceived": limits.silence_lookback_min + limits.silence_for_min,
            "TrafficGap": limits.gap_lookback_min + limits.gap_for_min}
    out = rows.groupBy("alertname").transformWithStateInPandas(
        Silence(need), "alertname string, state string, gap_start_us long, gap_end_us long", "append", "eventTime")
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")          # noqa: E731
    mins = F.when(F.col("alertname") == "TrafficGap", need["TrafficGap"]).otherwise(need["NoPredictionsReceived"])
    return out.select("alertname", "state", at("gap_start_us").alias("gap_start"), at("gap_end_us").alias("gap_end"),
                      at(F.col("gap_start_us") + mins.cast("long") * MINUTE_US).alias("firing_from"))


def sustained_stream(log: DataFrame, limits: Limits = Limits(), delay: str = "10 minutes") -> DataFrame:
    """T8 + W6: (alertname, severity, ets, window_end) of each minute at which the error rate or the latency rule fires.

    Three windowed aggregates: minutes, 5-minute windows sliding by one, and runs of ``sustained_min`` + 1 minutes
    in which every evaluation was true.
    """
    le = [f"le_{i}" for i in range(len(LATENCY_BOUNDS))]
    sliding = (minute_stream(log, delay).groupBy(F.window("ets", "5 minutes", "1 minute").alias("w"))
               .agg(*[F.sum(c).alias(c) for c in ("errors", "requests", *le)])
               .withColumn("le_inf", F.col("requests")))
    true = F.array_compact(F.array(
        F.when(F.col("errors") / F.lit(300.0) > limits.error_rate, F.lit("HighErrorRate")),
        F.when(histogram_quantile(0.99) > limits.latency_p99, F.lit("HighPredictionLatency"))))
    evaluated = sliding.select(F.window_time("w").alias("ets"), F.explode(true).alias("alertname"))
    held = limits.sustained_min + 1
    runs = (evaluated.groupBy("alertname", F.window("ets", f"{held} minutes", "1 minute").alias("w"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == held))
    severity = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    return runs.select("alertname", severity[F.col("alertname")].alias("severity"), F.window_time("w").alias("ets"),
                       (F.col("w.end") - F.expr("INTERVAL 1 MINUTE")).cast("timestamp_ntz").alias("window_end"))


def notice_stream(firing: DataFrame, repeat_min: int = REPEAT_INTERVAL_MIN) -> DataFrame:
    """A stream of firing minutes (alertname, severity, ets with a watermark, window_end) -> (alertname, severity,
    notice_at, firing_minutes) as ``group_notices`` gives them."""
    rows = firing.select("ets", "alertname", "severity", F.unix_micros(F.col("window_end").cast("timestamp")).alias("us"))
    out = rows.groupBy("alertname", "severity").transformWithStateInPandas(
        Notices(repeat_min), "alertname string, severity string, notice_us long, firing_minutes long", "append", "eventTime")
    return out.select("alertname", "severity", F.timestamp_micros("notice_us").cast("timestamp_ntz").alias("notice_at"), "firing_minutes")


def prediction_counts(scored: DataFrame) -> DataFrame:
    """Running totals of a scored stream by prediction and confidence (refused rows have neither)."""
    return scored.groupBy("prediction", "confidence").agg(F.count(F.lit(1)).cast("long").alias("count"))
