"""Streams that remember: equal to the batch rules, whatever the arrival order, also after a restart."""

import datetime as dt
import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from trialframe.operators.cooldown import apply_cooldown
from trialframe.operators.drift import exact_ks_tail, ks_statistics, windowed_ks
from trialframe.operators.requests import (
    Limits, exact_quantiles, firing_alerts, group_notices, request_log, silences)
from trialframe.streaming.stateful import (
    notice_stream, prediction_counts, retrain_stream, rocksdb_state, silence_stream, sustained_stream)
from trialframe.streaming.streams import (
    drift_slice_writer, read_stream, run_foreach_batch, run_to_table, slice_counts, table_stream, time_feed, windowed_counts)

LOW = Limits(error_rate=0.001, latency_p99=0.35, sustained_min=1, silence_lookback_min=3, silence_for_min=3)
T0 = dt.datetime(2024, 1, 1)
SCHEMA = "pipeline string, trigger_id long, ts timestamp_ntz, retrain boolean"


def arrive(spark, rows, directory, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(directory)


def watermark(rows, delay_min=10):
    top = max(r[2] for r in rows if r[3])
    at = top - dt.timedelta(minutes=delay_min)
    return at.replace(microsecond=at.microsecond // 1000 * 1000)


def batch_cooldown(spark, rows, cooldown_s):
    want = set()
    for pipeline in {r[0] for r in rows}:
        asked = [(r[1], r[2]) for r in rows if r[0] == pipeline and r[3]]
        got = apply_cooldown(spark.createDataFrame(asked, "trigger_id long, ts timestamp_ntz"), cooldown_s)
        want |= {(pipeline, r.trigger_id, r.ts, r.accepted) for r in got.collect()}
    return want


def test_cooldown_out_of_order_and_restarted(spark, tmpdir_path):
    draw = random.Random(3)
    rows = [(draw.choice("ab"), i, T0 + dt.timedelta(seconds=draw.randint(0, 3000), microseconds=draw.randint(0, 3) * 250), draw.random() < 0.8)
            for i in range(120)]
    rows += [("a", 900 + i, T0 + dt.timedelta(seconds=600), True) for i in range(3)]            # one instant
    rows.sort(key=lambda r: (r[2] + dt.timedelta(seconds=draw.randint(0, 500)), r[1]))          # up to 500 s out of order
    src, out, ckpt = (f"{tmpdir_path}/{x}" for x in ("in", "out", "ckpt"))
    for part in (rows[:30], rows[30:70], rows[70:]):            # each run starts from the last one's checkpoint
        arrive(spark, part[::2], src)
        arrive(spark, part[1::2], src)
        with rocksdb_state(spark):
            run_to_table(retrain_stream(read_stream(spark, src), 300, "15 minutes"), out, ckpt)
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    before = watermark(rows, 15)
    assert len(got) > 50 and got == {r for r in batch_cooldown(spark, rows, 300) if r[2] <= before}


def test_cooldown_rows_behind_the_watermark_are_dropped_and_counted(spark, tmpdir_path):
    src, out, ckpt, account = (f"{tmpdir_path}/{x}" for x in ("in", "out", "ckpt", "account"))
    at = lambda m: T0 + dt.timedelta(minutes=m)      # noqa: E731
    arrive(spark, [("a", 1, at(0), True), ("a", 2, at(60), True)], src)
    arrive(spark, [("a", 4, at(70), True)], src)
    arrive(spark, [("a", 3, at(20), True), ("a", 5, at(120), True)], src)         # 3 comes when all up to 50 is decided
    with rocksdb_state(spark):
        run_to_table(retrain_stream(read_stream(spark, src), 300), out, ckpt, account=account)
    assert sorted(r.trigger_id for r in spark.read.parquet(out).collect()) == [1, 2, 4]
    assert spark.read.parquet(account).agg(F.sum("late_rows")).first()[0] == 1


def test_late_row_of_a_windowed_count_is_accounted(spark, tmpdir_path):
    src, schema = f"{tmpdir_path}/in", "ts timestamp_ntz, event_type string, value double"
    at = lambda m: T0 + dt.timedelta(minutes=m)      # noqa: E731
    for rows in ([(at(0), "x", 1.0), (at(200), "x", 1.0)], [(at(210), "x", 1.0)], [(at(1), "x", 1.0)], [(at(400), "x", 1.0)]):
        arrive(spark, rows, src, schema)
    out = run_to_table(windowed_counts(read_stream(spark, src)), f"{tmpdir_path}/o", f"{tmpdir_path}/c", account=f"{tmpdir_path}/a")
    assert spark.read.parquet(f"{tmpdir_path}/a").agg(F.sum("late_rows")).first()[0] == 1
    assert spark.read.parquet(out).agg(F.sum("count")).first()[0] == 3


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


@pytest.fixture(scope="module")
def before(events):
    at = events.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    return at.replace(microsecond=at.microsecond // 1000 * 1000)


def run(spark, events, root, make, parts=3):
    with rocksdb_state(spark):
        return spark.read.parquet(run_to_table(make(read_stream(spark, time_feed(events, "ts", parts, f"{root}/in"))), f"{root}/o", f"{root}/c"))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_silences_close_as_in_batch_and_open_by_timer(spark, events, before, tmpdir_path):
    got = run(spark, events, tmpdir_path, lambda s: silence_stream(request_log(s), LOW))
    want = None
    for name, lookback, held, ok in (("NoPredictionsReceived", 3, 3, True), ("TrafficGap", 1, 1, False)):
        s = silences(request_log(events), lookback, held, status_ok=ok).select(
            F.lit(name).alias("alertname"), "gap_start", "gap_end", "firing_from")
        want = s if want is None else want.unionByName(s)
    whole = F.date_trunc("minute", "gap_end") + F.expr("INTERVAL 1 MINUTE") <= F.lit(before)
    assert same(got.where("state = 'closed'").drop("state"), want.where(whole))
    opened = got.where("state = 'open'")
    assert opened.where("gap_end IS NULL").count() == opened.count() > 0
    last = opened.groupBy("alertname").agg(F.max("gap_start").alias("gap_start"))
    assert same(last, want.where(~whole).groupBy("alertname").agg(F.max("gap_start").alias("gap_start")))     # still open at the end


def test_open_silence_fires_once(spark, tmpdir_path):
    src, schema = f"{tmpdir_path}/in", "ts timestamp_ntz, status int, latency_s double"
    at = lambda m: T0 + dt.timedelta(minutes=m)      # noqa: E731
    for rows in ([(at(0), 200, 0.1)], [(at(100), 500, 0.1)], [(at(150), 500, 0.1)], [(at(200), 200, 0.1)], [(at(300), 200, 0.1)]):
        arrive(spark, rows, src, schema)
    with rocksdb_state(spark):
        run_to_table(silence_stream(read_stream(spark, src)), f"{tmpdir_path}/o", f"{tmpdir_path}/c")
    got = [tuple(r) for r in spark.read.parquet(f"{tmpdir_path}/o").where("alertname = 'NoPredictionsReceived'").orderBy("gap_start", "state").collect()]
    assert got == [("NoPredictionsReceived", "closed", at(0), at(200), at(60)), ("NoPredictionsReceived", "open", at(0), None, at(60)),
                   ("NoPredictionsReceived", "open", at(200), None, at(260))]


def test_alerts_and_notices_equal_batch(spark, events, before, tmpdir_path):
    names = ("HighErrorRate", "HighPredictionLatency")
    fired = firing_alerts(request_log(events), LOW).where(F.col("alertname").isin(*names)).where(
        F.col("window_end") + F.expr("INTERVAL 1 MINUTE") <= F.lit(before))
    got = run(spark, events, f"{tmpdir_path}/a", lambda s: sustained_stream(request_log(s), LOW).drop("ets"))
    assert got.count() > 0 and same(got, fired.select("alertname", "severity", "window_end"))
    told = run(spark, events, f"{tmpdir_path}/n", lambda s: notice_stream(sustained_stream(request_log(s), LOW)), parts=4)
    assert told.count() > 0 and same(told, group_notices(fired).where(F.col("notice_at") + F.expr("INTERVAL 60 MINUTES") <= F.lit(before)))


def test_slice_verdicts_do_not_depend_on_arrivals(spark, events, before, tmpdir_path):
    split = F.lit(dt.datetime(2024, 1, 8))
    ref, cur = events.where(F.col("ts") < split), events.where(F.col("ts") >= split)
    cols = ["slice_start", "ks_statistic", "p_value", "drifted", "n_ref", "n_cur"]
    want = windowed_ks(ref, cur.withColumn("slice_start", F.date_trunc("day", "ts").cast("timestamp_ntz")), "value", "slice_start", places=9).where(
        F.col("slice_start") + F.expr("INTERVAL 1 DAY") <= F.lit(before)).select(cols)
    for parts in (1, 4):
        root = f"{tmpdir_path}/{parts}"
        src = read_stream(spark, time_feed(cur, "ts", parts, f"{root}/in"))
        run_foreach_batch(slice_counts(src, "value", "1 day"), drift_slice_writer(ref, "value", f"{root}/o", f"{root}/counts"), f"{root}/c")
        got = spark.read.parquet(f"{root}/o").select("slice_start", *[F.bround(c, 9).alias(c) for c in cols[1:3]], *cols[3:])
        assert want.count() > 10 and same(got, want)


def test_prediction_counts_equal_batch(spark, tmpdir_path):
    from trialframe.functions.recipe import engineer_features, fit_scale
    from trialframe.ml.train import build_pipeline, candidates, load_scorer, save_model, scale_values, score, with_label
    from trialframe.plans.fixtures import shifted_production
    from trialframe.sources.tables import trials
    from trialframe.streaming.streams import changed_windows_writer
    t = shifted_production(trials(spark, SF_SMALL))
    scale = scale_values(fit_scale(t))
    feats = engineer_features(t, scale=scale)
    save_model(build_pipeline(candidates(1000)["logistic_regression"]()).fit(with_label(feats)), f"{tmpdir_path}/m", scale, name="lr")
    scorer = load_scorer(spark, f"{tmpdir_path}/m")
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").repartition(3).write.parquet(f"{tmpdir_path}/in")
    stream = shifted_production(trials(spark, SF_SMALL, lineitem=read_stream(spark, f"{tmpdir_path}/in")))
    run_foreach_batch(prediction_counts(score(scorer, stream, "2024-02-01 00:00:00")), changed_windows_writer(f"{tmpdir_path}/o"),
                      f"{tmpdir_path}/c", mode="update")
    written = spark.read.parquet(f"{tmpdir_path}/o")
    assert written.select("batch_id").distinct().count() == 3
    got = written.groupBy("prediction", "confidence").agg(F.max_by("count", "batch_id").alias("count"))
    assert same(got, prediction_counts(score(scorer, t, "2024-02-01 00:00:00")))


def test_exact_window_quantiles(spark):
    draw = random.Random(9)
    rows = [(T0 + dt.timedelta(seconds=draw.randint(0, 900)), draw.choice([0.1, 0.1, 0.1, draw.random() * 5])) for _ in range(600)]
    rows += [(T0, None), (T0, float("nan")), (T0 + dt.timedelta(hours=1), 7.5)]
    got = exact_quantiles(spark.createDataFrame(rows, "ts timestamp_ntz, latency_s double"), [0.0, 0.5, 0.95, 0.99, 1.0])
    by_end = {}
    for ts, v in rows:
        if v is not None and v == v:
            for k in range(5):
                by_end.setdefault(ts.replace(second=0) + dt.timedelta(minutes=k), []).append(v)
    found = {r.window_end: (r.n, *[r[f"q_{i}"] for i in range(5)]) for r in got.collect()}
    assert found.keys() == by_end.keys()
    for end, values in by_end.items():
        assert found[end][0] == len(values)
        assert found[end][1:] == pytest.approx(np.quantile(values, [0.0, 0.5, 0.95, 0.99, 1.0]))


def test_exact_law_equals_enumeration():
    for n1, n2 in ((1, 1), (2, 3), (4, 4), (5, 3), (6, 4), (3, 7)):
        ds = []
        for places in itertools.combinations(range(n1 + n2), n1):
            a = b = 0
            top = 0.0
            for k in range(n1 + n2):
                a, b = (a + 1, b) if k in places else (a, b + 1)
                top = max(top, abs(a / n1 - b / n2))
            ds.append(top)
        for d in sorted(set(ds)):
            assert exact_ks_tail(d, n1, n2) == pytest.approx(np.mean([x >= d - 1e-12 for x in ds]), abs=1e-12)
            assert exact_ks_tail(d, n2, n1) == pytest.approx(exact_ks_tail(d, n1, n2))
    assert exact_ks_tail(0.0, 5, 5) == 1.0 and exact_ks_tail(1.0, 300, 500) == pytest.approx(0.0, abs=1e-12)
    from trialframe.operators.drift import ks_pvalue     # noqa: F401  large samples meet the limit
    lam = 0.02 * np.sqrt(9000 * 10000 / 19000)
    limit = 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 20))
    assert exact_ks_tail(0.02, 9000, 10000) == pytest.approx(limit, abs=0.01)


def test_small_samples_take_the_exact_law(spark):
    ref, cur = pd.DataFrame({"x": np.arange(20.0)}), pd.DataFrame({"x": np.arange(8.0) + 9.5})
    r = ks_statistics(spark.createDataFrame(ref), spark.createDataFrame(cur), ["x"], places=None, exact=True).first()
    assert r.method == "ks_exact" and r.p_value == pytest.approx(exact_ks_tail(r.ks_statistic, 20, 8))
    many = spark.range(10_001).select(F.col("id").cast("double").alias("x"))
    assert ks_statistics(many, spark.createDataFrame(cur), ["x"], exact=True).first().method == "ks_asymptotic"
