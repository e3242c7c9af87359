"""The pipeline job: a cut-off run goes on after its last finished stage; the retrain stream starts it."""

import datetime as dt

from tests.conftest import SF_SMALL
from trialframe.plans import jobs
from trialframe.sources.audit import read_audit
from trialframe.sources.store import current_model, read_registry
from trialframe.streaming.stateful import retrain_stream, rocksdb_state
from trialframe.streaming.streams import read_stream, run_foreach_batch

LR = ["logistic_regression"]


def test_cut_off_run_goes_on_after_its_last_stage(spark, tmpdir_path, monkeypatch):
    whole, summary = jobs.run_pipeline(spark, SF_SMALL, f"{tmpdir_path}/whole", LR, run_id="whole")
    assert summary.first().all_passed, whole.collect()
    root, fit = f"{tmpdir_path}/cut", jobs.compare_models

    def killed(*args, **kwargs):
        raise RuntimeError("lost")
    monkeypatch.setattr(jobs, "compare_models", killed)
    stages, summary = jobs.run_pipeline(spark, SF_SMALL, root, LR, run_id="one")
    assert [(r.stage, r.status) for r in stages.collect()] == [("validate", "SUCCESS"), ("features", "SUCCESS"), ("train", "FAILED")]
    assert not summary.first().all_passed

    monkeypatch.setattr(jobs, "compare_models", fit)
    monkeypatch.setattr(jobs, "run_suite", killed)              # finished stages are not run again
    monkeypatch.setattr(jobs, "engineer_features", killed)
    stages, summary = jobs.run_pipeline(spark, SF_SMALL, root, LR, run_id="one")
    assert [(r.stage, r.status) for r in stages.collect()] == [
        ("validate", "RESUMED"), ("features", "RESUMED"), ("train", "SUCCESS"), ("qualify", "SUCCESS"), ("register", "SUCCESS")]
    assert summary.first().all_passed
    a, b = (current_model(read_registry(spark, r)).first() for r in (f"{tmpdir_path}/whole", root))
    assert (a.model, a.best_f1, a.feature_columns) == (b.model, b.best_f1, b.feature_columns)
    again, _ = jobs.run_pipeline(spark, SF_SMALL, root, LR, run_id="one")
    assert {r.status for r in again.collect()} == {"RESUMED"} and read_registry(spark, root).count() == 1


def test_accepted_verdicts_of_a_stream_run_the_stages_once(spark, tmpdir_path, monkeypatch):
    started = []

    def stages(spark, sf_dir, root, candidates=None, run_id=None):
        started.append(run_id)
        table = spark.createDataFrame([(s, "SUCCESS", 0.1, None) for s in jobs.STAGES], "stage string, status string, duration_s double, error string")
        return table, jobs.run_summary(table, len(jobs.STAGES))
    monkeypatch.setattr(jobs, "run_pipeline", stages)
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)     # noqa: E731
    rows = [("p", 1, at(0), True), ("p", 2, at(100), True), ("p", 3, at(301), True), ("q", 4, at(200), False), ("q", 5, at(250), True),
            ("p", 6, at(5000), True)]
    src = f"{tmpdir_path}/in"
    spark.createDataFrame(rows, "pipeline string, trigger_id long, ts timestamp_ntz, retrain boolean").write.parquet(src)
    with rocksdb_state(spark):
        run_foreach_batch(retrain_stream(read_stream(spark, src, max_files=10), 300), jobs.retrain_batch_writer(SF_SMALL, tmpdir_path, LR), f"{tmpdir_path}/c")
    assert started == ["p-1", "q-5", "p-3"]
    assert read_audit(spark, f"{tmpdir_path}/audit").where("event = 'retrain_finished'").count() == 3


def test_retrain_if_drifted_decides_once(spark, tmpdir_path, monkeypatch):
    started = []
    monkeypatch.setattr(jobs, "run_pipeline", lambda spark, sf_dir, root, candidates=None: started.append(root))
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)     # noqa: E731
    verdicts = spark.createDataFrame([(1, at(0), True), (2, at(10), True), (3, at(20), False), (4, at(400), True)],
                                     "trigger_id long, ts timestamp_ntz, retrain boolean")
    decided = jobs.retrain_if_drifted(spark, SF_SMALL, tmpdir_path, verdicts, 300, LR)
    assert [(r.trigger_id, r.started) for r in decided.orderBy("trigger_id").collect()] == [(1, True), (2, False), (3, False), (4, True)]
    assert len(started) == 2 and read_audit(spark, f"{tmpdir_path}/audit").count() == 2
