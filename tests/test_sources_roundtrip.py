"""Readers, writers and small helpers: round trips, malformed lines, absent columns."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from trialframe.operators.contract import drop_if_exists, select_available
from trialframe.operators.quality import failed_checks, run_suite
from trialframe.sources.audit import audit_append, read_audit, recent_entries
from trialframe.sources.tables import RAW_COLUMNS, read_trials, trials, write_trials


def test_trials_round_trip(spark, tmpdir_path):
    raw = trials(spark, SF_SMALL).select(*RAW_COLUMNS)
    for fmt in ("parquet", "csv"):
        write_trials(raw, f"{tmpdir_path}/{fmt}", fmt)
        back = read_trials(spark, f"{tmpdir_path}/{fmt}", fmt)
        assert back.columns == raw.columns and back.count() == raw.count()
        number = "mol_weight"
        assert abs(back.agg(F.sum(number)).first()[0] - raw.agg(F.sum(number)).first()[0]) < 1e-6 * raw.count()


def test_malformed_audit_lines_are_dropped(spark, tmpdir_path):
    root = f"{tmpdir_path}/audit"
    for i in range(3):
        audit_append(spark, root, f"event_{i}", {"i": i})
    spark.createDataFrame([("{not json", "20240101")], "value string, day string").write.mode("append").partitionBy("day").text(root)
    rows = read_audit(spark, root)
    assert rows.count() == 3
    assert [r.event for r in recent_entries(rows, 2).collect()] == ["event_2", "event_1"]


def test_columns_and_failed_checks(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    kept, absent = select_available(df, ["b", "z", "a"])
    assert kept.columns == ["b", "a"] and absent == ["z"]
    assert drop_if_exists(df, ["b", "z"]).columns == ["a"]
    results = run_suite(trials(spark, SF_SMALL).select(*RAW_COLUMNS))
    failed = failed_checks(results)
    assert failed.count() == results.where("status = 'FAIL'").count() and failed.where("status = 'PASS'").isEmpty()
