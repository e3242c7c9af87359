"""No caps, no switches, no lost rows: skewed, null, NaN, long and late inputs."""

import datetime as dt
import math
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialframe.operators.contract import column_report
from trialframe.operators import cooldown
from trialframe.operators.cooldown import apply_cooldown, retrain_decisions
from trialframe.operators.drift import (append_history, chi_square_critical, chi_square_tail, drift_history_entry, drift_summary,
                                        history_status, ks_statistics, ranked, second_test)
from trialframe.operators.evaluate import roc_auc
from trialframe.operators.prefix import _with_range, running_totals
from trialframe.operators.profile import column_stats, null_profile
from trialframe.operators.quality import Check, check_values, run_suite
from trialframe.operators.quantiles import exact_medians, exact_quantile_long
from trialframe.operators.requests import Limits, firing_alerts, group_notices, silences
from trialframe.operators.split import stratified_folds, stratified_split

NAN = float("nan")


def test_outlier_does_not_stretch_the_ranges(spark):
    rows = [(1_000_000.0 + i / 7, 1) for i in range(20_000)] + [(0.0, 1)]
    df = spark.createDataFrame(rows, "v double, c long")
    sizes = [r["count"] for r in _with_range(df, "v", [], 256).groupBy("_b").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 2_000
    got = {r.v: r.cum_c for r in running_totals(df, "v", ["c"]).collect()}
    assert [got[v] for v in sorted(got)] == list(range(1, 20_002))


def test_null_keys_and_strata_are_kept(spark):
    rows = [(None if i % 10 == 0 else "a", float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("c", F.lit(1))
    got = running_totals(df, "v", ["c"], keys=["k"]).collect()
    assert len(got) == 200 and max(r.cum_c for r in got if r.k is None) == 20
    labelled = spark.createDataFrame([(f"id{i}", None if i % 10 == 0 else i % 2) for i in range(300)], "id string, y int")
    split = stratified_split(labelled, "id", "y")
    counts = {(r.y, r.is_test): r["count"] for r in split.groupBy("y", "is_test").count().collect()}
    assert sum(counts.values()) == 300 and counts[(None, True)] == 6
    assert all(counts[(y, True)] == math.ceil(0.2 * (counts[(y, True)] + counts[(y, False)])) for y in (0, 1, None))
    assert stratified_folds(labelled, "id", "y").count() == 300
    by = spark.createDataFrame([(None if i % 2 else "x", i % 3 % 2, i / 100) for i in range(120)], "g string, y int, s double")
    assert {r.g for r in roc_auc(by, "y", "s", by=["g"]).collect()} == {None, "x"}


def test_folds_and_split_agree_with_ranks(spark):
    df = spark.createDataFrame([(f"id{i}", i % 2) for i in range(101)], "id string, y int")
    folds = stratified_folds(df, "id", "y", 5)
    for y, n in ((0, 51), (1, 50)):
        sizes = sorted(r["count"] for r in folds.where(F.col("y") == y).groupBy("fold").count().collect())
        assert sum(sizes) == n and sizes[-1] - sizes[0] <= 1


def test_all_values_of_a_list_check_are_reported(spark):
    df = spark.createDataFrame([(float(i % 25),) for i in range(500)], "dose double")
    check = Check("dose_valid", "isin", "dose", {"values": [0.0, 1.0]})
    got = {r.value: r.n for r in check_values(df, [check]).collect()}
    assert got == {str(float(i)): 20 for i in range(25)}
    assert run_suite(df, [check]).first().details == "distinct_values=25"


def test_chi_square_beyond_ten_degrees(spark):
    assert chi_square_critical(12) == pytest.approx(21.0260698, abs=1e-6)
    assert chi_square_critical(1) == pytest.approx(3.8414588, abs=1e-6) and chi_square_tail(21.0260698, 12) == pytest.approx(0.05, abs=1e-7)
    ref = spark.createDataFrame([(float(i % 13),) for i in range(1300)], "x double")
    cur = spark.createDataFrame([(float(i % 13),) for i in range(130)] + [(0.0,)] * 12, "x double")
    r = second_test(ref, cur, ["x"], categorical=["x"]).first()
    counts = [22] + [10] * 12
    stat = sum((c - 142 / 13) ** 2 / (142 / 13) for c in counts)
    assert r.threshold == pytest.approx(21.0260698, abs=1e-6) and r.statistic == pytest.approx(stat, abs=1e-9)
    assert not r.drifted      # by the old table's last entry, 18.307 at ten degrees, the verdict would hang on a wrong limit
    with pytest.raises(Exception, match="more than 5 reference values"):
        second_test(ref, cur, ["x"], categorical=["x"], max_values=5).collect()


def test_kind_of_test_does_not_follow_the_number_of_values(spark):
    few = spark.createDataFrame([(float(i % 3),) for i in range(60)], "x double")
    many = spark.createDataFrame([(float(i),) for i in range(60)], "x double")
    for frame in (few, many):
        assert second_test(frame, frame, ["x"]).first().test == "wasserstein_norm"


def test_median_of_hot_values(spark):
    rows = [(1.0 if i % 2 else 0.0, float(i % 5), None if i % 4 else NAN) for i in range(1_001)]
    df = spark.createDataFrame(rows, "flag double, dose double, gone double")
    got = {r.column: r.median for r in exact_medians(df, ["flag", "dose", "gone"]).collect()}
    assert got == {"flag": 0.0, "dose": 2.0}
    plan = exact_medians(df, ["flag", "dose"])._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
    long = spark.createDataFrame([("a", float(i)) for i in range(10)] + [(None, 3.0), (None, NAN)], "column string, value double")
    assert {r["column"]: r.quantile for r in exact_quantile_long(long, 0.25).collect()} == {"a": 2.25, None: 3.0}


def test_nan_counts_as_null(spark):
    x = [float(i) for i in range(500)]
    df = spark.createDataFrame([(v, 1) for v in x] + [(NAN, 1)] * 5, "x double, n int")
    checks = [Check("x_range", "range", "x", {"lo": 0, "hi": 1000}), Check("x_known", "not_null", "x"),
              Check("x_positive", "rule", "x", {"op": ">=", "bound": 0}), Check("nulls", "null_rate", None, {"below": 0.001})]
    got = {r.check: (r.status, r.observed) for r in run_suite(df, checks).collect()}
    assert got["x_range"] == ("FAIL", 5.0) and got["x_known"] == ("FAIL", 5.0) and got["x_positive"] == ("FAIL", 5.0)
    assert got["nulls"][0] == "FAIL" and got["nulls"][1] == pytest.approx(5 / 1010)
    assert {r.column: r.nulls for r in null_profile(df).collect()} == {"x": 5, "n": 0, "*": 5}
    stats = {r.column: r for r in column_stats(df, ["x"]).collect()}["x"]
    assert (stats["mean"], stats["max"], stats["median"]) == (249.5, 499.0, 249.5)
    clean = df.where(~F.isnan("x"))
    assert ks_statistics(df, clean, ["x"]).first().n_ref == 500


def test_silence_up_to_now(spark):
    start = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([(start + dt.timedelta(minutes=m), 200) for m in range(0, 60, 5)], "ts timestamp_ntz, status int")
    assert silences(log).count() == 0
    now = F.lit(start + dt.timedelta(minutes=55 + 120))
    got = silences(log, as_of=now).collect()
    assert [(r.gap_start, r.gap_end) for r in got] == [(start + dt.timedelta(minutes=55), start + dt.timedelta(minutes=175))]
    failing = spark.createDataFrame([(start + dt.timedelta(minutes=m), 500) for m in range(0, 120, 5)], "ts timestamp_ntz, status int")
    assert silences(failing).count() == 1        # never a prediction


def test_notices_repeat_from_the_last_one(spark):
    minutes = [59, 60, 61, 118, 119, 200]
    firing = spark.createDataFrame([("A", "warning", m) for m in minutes] + [("B", "critical", 60)],
                                   "alertname string, severity string, end_minute long")
    got = sorted((r.alertname, r.notice_at, r.firing_minutes) for r in group_notices(firing, 60).collect())
    at = lambda m: dt.datetime(1970, 1, 1) + dt.timedelta(minutes=m)      # noqa: E731
    assert got == [("A", at(59), 4), ("A", at(119), 1), ("A", at(200), 1), ("B", at(60), 1)]


def test_all_four_rules_can_fire(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=2 * i), 500 if i % 2 else 200, 3.0) for i in range(600)]
    rows += [(start + dt.timedelta(minutes=90), 200, 0.1)]
    log = spark.createDataFrame(rows, "ts timestamp_ntz, status int, latency_s double")
    got = {(r.alertname, r.severity) for r in firing_alerts(log, Limits(latency_p99=1.9)).collect()}
    assert got == {("HighErrorRate", "warning"), ("HighPredictionLatency", "warning"), ("NoPredictionsReceived", "warning"),
                   ("TrafficGap", "critical")}


def greedy(times, cool):
    out, last = [], None
    for t in sorted(times):
        if last is None or t - last >= cool:
            out.append(t)
            last = t
    return out


def test_long_run_of_triggers_is_not_one_group(spark):
    df = spark.range(100_000).select(F.col("id").alias("trigger_id"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"))
    out = apply_cooldown(df, 300)
    assert out.where("accepted").count() == 20_000
    assert out.where("accepted and trigger_id % 5 != 0").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("FlatMapCoGroupsInPandas")[0]


def test_cooldown_of_random_triggers(spark):
    r = np.random.default_rng(3)
    for gap in (20, 299, 301, 9_000):
        times = np.cumsum(r.integers(1, 2 * gap, size=800)).tolist()
        df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t)) for i, t in enumerate(times)],
                                   "trigger_id long, ts timestamp_ntz")
        got = sorted(times[x.trigger_id] for x in apply_cooldown(df, 300).where("accepted").collect())
        assert got == greedy(times, 300)


@pytest.mark.parametrize("fan", [2, 32])
def test_cooldown_tree_of_many_levels(spark, monkeypatch, fan):
    """Keys with triggers a millisecond apart, with gaps of many chunks, before the epoch, and one trigger only."""
    monkeypatch.setattr(cooldown, "FAN", fan)
    r = np.random.default_rng(fan)
    second = 1_000_000
    dense = np.concatenate([start * second + 1_000 * np.arange(4_000) for start in (0, 3, 11, 900, 903)])
    keyed = {"dense": np.unique(dense), "sparse": np.cumsum(r.integers(1, 4_000, size=300)) * second - 200_000 * second,
             "steady": np.arange(-500, 2_500) * second, "one": np.array([7])}
    rows = [(k, int(t)) for k, times in keyed.items() for t in times]
    out = cooldown.cover(spark.createDataFrame(rows, "k string, _us long"), 10, ["k"]).toPandas()
    assert len(out) == len(rows)
    for k, times in keyed.items():
        accepted = greedy(times.tolist(), 10 * second)
        got = out[out.k == k].sort_values("_us")
        assert got[got._us == got._by]._us.tolist() == accepted
        assert got._by.tolist() == [accepted[i] for i in np.searchsorted(accepted, got._us, side="right") - 1]
    none = spark.createDataFrame([], "k string, _us long")
    assert cooldown.cover(none, 10, ["k"]).collect() == []


def test_drift_verdicts_pass_the_cooldown(spark):
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)      # noqa: E731
    v = spark.createDataFrame([(1, at(0), False), (2, at(1), True), (3, at(3), True), (4, at(6), True)],
                              "trigger_id long, ts timestamp_ntz, retrain boolean")
    assert {r.trigger_id: r.started for r in retrain_decisions(v).collect()} == {1: False, 2: True, 3: False, 4: True}


def test_drift_history_and_ranking(spark, tmpdir_path):
    per = spark.createDataFrame([(0, "a", 0.2, 0.5, False, 9, 9), (1, "b", 0.9, 0.0, True, 9, 9), (2, "c", None, None, False, 0, 9)],
                                "ord int, column string, ks_statistic double, p_value double, drifted boolean, n_ref long, n_cur long")
    assert [r["column"] for r in ranked(per).collect()] == ["b", "a", "c"]
    for i, day in enumerate(("2024-01-01", "2024-01-03", "2024-01-02")):
        append_history(drift_history_entry(drift_summary(per, 9, 9), f"r{i}", day), tmpdir_path)
    status = history_status(spark.read.parquet(f"{tmpdir_path}/drift_history")).first()
    assert status.n_reports == 3 and status.latest.report_id == "r1" and status.latest.n_drifted_features == 1


def test_column_report_reads_the_table(spark):
    df = spark.createDataFrame([(1.0, None), (NAN, "x")], "a double, b string")
    got = [(r["column"], r.present, r.nulls) for r in column_report(df, ["b", "a", "z"]).collect()]
    assert got == [("b", True, 1), ("a", True, 1), ("z", False, 2)]


def test_a_cluster_without_a_shared_folder_is_an_error():
    from trialframe.session import ensure_checkpoint_dir
    conf = types.SimpleNamespace(get=lambda k, d=None: d)
    context = types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(types.SimpleNamespace(conf=conf, sparkContext=context))
