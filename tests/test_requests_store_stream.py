"""Request-log rules, cooldown, store, audit, streaming and the driver contract."""

import datetime as dt
import random

from pyspark.sql import functions as F

from trialframe.operators.cooldown import apply_cooldown
from trialframe.operators.requests import silences, sustained
from trialframe.sources.audit import audit_append, completeness, read_audit
from trialframe.sources.store import catalog, latest_version, save_feature_set, upsert
from trialframe.streaming.streams import run_to_table, table_stream, windowed_counts

from conftest import SF_SMALL


def test_sustained_needs_every_minute(spark):
    cond = spark.createDataFrame([(m,) for m in [10, 11, 12, 13, 14, 15, 20, 21]], "end_minute long")
    got = sorted(r.end_minute for r in sustained(cond, 5).collect())
    assert got == [15]


def test_silence_gap(spark):
    base = dt.datetime(2024, 1, 1)
    ts = [base, base + dt.timedelta(minutes=10), base + dt.timedelta(minutes=95),
          base + dt.timedelta(days=1, minutes=30)]
    log = spark.createDataFrame([(t, 200) for t in ts], "ts timestamp_ntz, status int")
    g = sorted((r.gap_start, r.gap_end) for r in silences(log, 30, 30).collect())
    assert g == [(ts[1], ts[2]), (ts[2], ts[3])]


def _greedy(ts, cool):
    out, last = [], None
    for i, t in sorted(enumerate(ts), key=lambda x: (x[1], x[0])):
        ok = last is None or (t - last).total_seconds() >= cool
        out.append((i, ok))
        if ok:
            last = t
    return dict(out)


def test_cooldown_matches_sequential_rule(spark):
    rnd = random.Random(2)
    base = dt.datetime(2024, 1, 1, 23, 50)
    ts, t = [], base
    for _ in range(300):
        t = t + dt.timedelta(seconds=rnd.choice([5, 60, 120, 299, 300, 301, 900]))
        ts.append(t)
    ts.append(ts[10])   # a tie at one instant
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ts)], "trigger_id long, ts timestamp_ntz")
    got = {r.trigger_id: r.accepted for r in apply_cooldown(df, 300).collect()}
    assert got == _greedy(ts, 300)


def test_upsert_latest_wins(spark):
    old = spark.createDataFrame([("a", "v1", dt.datetime(2024, 1, 1), 1.0), ("b", "v1", dt.datetime(2024, 1, 1), 2.0)],
                                "key string, version string, created_at timestamp_ntz, x double")
    new = spark.createDataFrame([("a", "v1", dt.datetime(2024, 2, 1), 9.0), ("c", "v1", dt.datetime(2024, 2, 1), 3.0)],
                                "key string, version string, created_at timestamp_ntz, x double")
    got = {r.key: r.x for r in upsert(old, new, ["key", "version"]).collect()}
    assert got == {"a": 9.0, "b": 2.0, "c": 3.0}


def test_feature_store_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([("s1", 1.0), ("s2", 2.0)], "sample_id string, f double")
    save_feature_set(spark, tmpdir_path, "fs", "v1", df, "sample_id", "2024-01-01 00:00:00")
    df2 = spark.createDataFrame([("s2", 5.0), ("s3", 3.0)], "sample_id string, f double")
    save_feature_set(spark, tmpdir_path, "fs", "v1", df2, "sample_id", "2024-01-02 00:00:00")
    save_feature_set(spark, tmpdir_path, "fs", "v2", df2, "sample_id", "2024-01-03 00:00:00")
    data = spark.read.parquet(f"{tmpdir_path}/data").filter("version = 'v1'")
    assert data.count() == 3
    assert latest_version(catalog(spark, tmpdir_path)).first().version == "v2"


def test_audit_append_only_and_complete(spark, tmpdir_path):
    root = f"{tmpdir_path}/audit"
    for i in range(3):
        audit_append(spark, root, "stage_done", {"i": i})
    a = read_audit(spark, root)
    assert a.count() == 3
    assert completeness(a).count() == 0


def test_stream_equals_batch(spark, tmpdir_path):
    src = table_stream(spark, SF_SMALL, "events")
    out = run_to_table(windowed_counts(src), f"{tmpdir_path}/o", f"{tmpdir_path}/c")
    s = spark.read.parquet(out)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    mx = ev.agg(F.max("ts")).first()[0]
    b = windowed_counts(ev).filter(F.col("window_end") <= F.lit(mx - dt.timedelta(minutes=10)))
    assert s.count() == b.count() and s.exceptAll(b).count() == 0


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_pipeline_job_runs_all_stages(spark, tmpdir_path):
    from trialframe.plans.jobs import STAGES, run_pipeline
    from trialframe.sources.audit import read_audit
    stages, summary = run_pipeline(spark, SF_SMALL, tmpdir_path, candidates=["logistic_regression"])
    rows = stages.collect()
    assert [r.stage for r in rows] == STAGES, [(r.stage, r.status, r.error) for r in rows]
    assert summary.first().all_passed
    assert read_audit(spark, f"{tmpdir_path}/registry/../audit").count() == len(STAGES)
