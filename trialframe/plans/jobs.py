"""The pipeline job (G8): checks -> features -> train -> qualify -> register.

One Spark application calls the operators in order, stops at the first
failing stage, appends one audit entry per stage and returns the stage
table (L5).  "All passed" requires every expected stage to have run.

Every stage writes its outputs under ``root/runs_state/<run_id>`` and, when all are there, a mark with the few values that later
stages need.  A run started again with the same ``run_id`` takes finished stages from their marks and goes on after the last one;
a stage that was cut off runs again and overwrites what it left.
"""

from __future__ import annotations

import json
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.functions.recipe import FEATURE_COLS, engineer_features, fit_scale
from trialframe.ml.qualify import gate as qualification_gate
from trialframe.ml.qualify import qualify
from trialframe.ml.qualify import report as qualification_report
from trialframe.ml.qualify import verdict
from trialframe.ml.train import append_run, compare_models, run_log_row, save_model, scale_values
from trialframe.operators.cooldown import RETRAIN_COOLDOWN_S, retrain_decisions
from trialframe.operators.quality import gate as quality_gate
from trialframe.operators.quality import run_suite
from trialframe.operators.split import stratified_split
from trialframe.plans.fixtures import shifted_production
from trialframe.sources.audit import audit_append, run_summary, stage_table
from trialframe.sources.store import read_registry, register_model, registry_entry, save_feature_set
from trialframe.sources.tables import RAW_COLUMNS, read_report, table_exists, trials, write_report

STAGES = ["validate", "features", "train", "qualify", "register"]


def _marks(spark: SparkSession, state: str) -> dict[str, tuple[dict, float]]:
    """Finished stages of a run: their values and seconds."""
    if not table_exists(spark, f"{state}/marks"):
        return {}
    rows = spark.read.schema("stage string, facts string, duration_s double").json(f"{state}/marks").collect()      # one row a stage
    return {r["stage"]: (json.loads(r["facts"]), r["duration_s"]) for r in rows}


def _mark(spark: SparkSession, state: str, stage: str, values: dict, seconds: float) -> None:
    row = spark.createDataFrame([(stage, json.dumps(values), seconds)], "stage string, facts string, duration_s double")
    row.coalesce(1).write.mode("append").json(f"{state}/marks")


def run_pipeline(spark: SparkSession, sf_dir: str, root: str, candidates: list[str] | None = None,
                 run_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Run the stages; returns (stage table, one-row summary).  With the ``run_id`` of an earlier run, go on with that one:
    stages that it finished have status RESUMED."""
    run_id = run_id or uuid.uuid4().hex
    state = f"{root}/runs_state/{run_id}"
    done, results = _marks(spark, state), []
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    read = spark.read.parquet

    def validate() -> dict:
        t = shifted_production(trials(spark, sf_dir))
        checks = run_suite(t.filter(F.col("side") == "reference").select(*RAW_COLUMNS))
        write_report(checks, f"{root}/reports/validation")
        # duplicate sample ids are expected in the driver data: the gate allows 3 failures
        quality_gate(read_report(spark, f"{root}/reports/validation", checks.schema))
        return {"started_at": now}

    def features() -> dict:
        t = shifted_production(trials(spark, sf_dir))
        ref = t.filter(F.col("side") == "reference")
        scale = scale_values(fit_scale(ref))
        split = stratified_split(engineer_features(ref, scale=scale), "row_key", "efficacy_label")
        split.write.mode("overwrite").parquet(f"{state}/reference")
        engineer_features(t.filter(F.col("side") == "production"), scale=scale).write.mode("overwrite").parquet(f"{state}/production")
        save_feature_set(spark, f"{root}/features", "trial_features", "v1",
                         read(f"{state}/reference").drop("is_test", "side", "noise", "sample_id", "batch_id"),
                         "row_key", now)
        return {"scale": scale}

    def train() -> dict:
        ref = read(f"{state}/reference")
        res, models = compare_models(ref.filter(~F.col("is_test")), ref.filter(F.col("is_test")), names=candidates)
        rows = res.collect()                                        # one row a candidate
        best = next(r for r in rows if r["is_best"])
        path = f"{root}/models/{run_id}/{best['model']}"
        scores = {k: best[k] for k in ("accuracy", "precision", "recall", "f1_score", "roc_auc")}
        save_model(models[best["model"]], path, facts["features"]["scale"], name=best["model"], metrics=scores, trained_at=now, run_id=run_id)
        for r in rows:
            append_run(run_log_row(spark, run_id, r["model"], {"is_best": r["is_best"]}, {k: r[k] for k in scores}, now), root)
        return {"best": best["model"], "f1": best["f1_score"], "path": path}

    def qualify_stage() -> dict:
        ref = read(f"{state}/reference")
        checks = qualify(spark, facts["train"]["path"], ref.filter(F.col("is_test")), read(f"{state}/production"))
        write_report(qualification_report(checks), f"{root}/reports/qualification")
        found = verdict(checks).first().asDict()
        qualification_gate(checks)
        return found

    def register() -> dict:
        v, trained = facts["qualify"], facts["train"]
        entry = registry_entry(
            spark, model_name="drug_efficacy_classifier", version=run_id, model=trained["best"], registered_at=now,
            model_path=trained["path"], qualified_for_production=v["overall_qualification_status"] == "QUALIFIED",
            best_f1=float(trained["f1"]), iq_passed=v["iq"], oq_passed=v["oq"], pq_passed=v["pq"],
            feature_columns=FEATURE_COLS, feature_version="v1", run_id=run_id)
        there = table_exists(spark, f"{root}/registry") and not read_registry(spark, root).where(F.col("version") == run_id).isEmpty()
        if not there:           # cut off between the entry and the mark
            register_model(spark, root, entry)
        return {"version": run_id}

    facts = {stage: values for stage, (values, _) in done.items()}
    for name, fn in zip(STAGES, [validate, features, train, qualify_stage, register], strict=True):
        if name in done:
            results.append((name, "RESUMED", done[name][1], None))
            continue
        t0 = time.perf_counter()
        try:
            facts[name] = fn()
            seconds = time.perf_counter() - t0
            _mark(spark, state, name, facts[name], seconds)
            results.append((name, "SUCCESS", seconds, None))
            audit_append(spark, f"{root}/audit", f"stage_{name}", {"status": "SUCCESS", "run_id": run_id})
        except Exception as e:  # noqa: BLE001 - recorded as the stage result, then stop
            results.append((name, "FAILED", time.perf_counter() - t0, f"{type(e).__name__}: {e}"))
            audit_append(spark, f"{root}/audit", f"stage_{name}", {"status": "FAILED", "run_id": run_id})
            break
    stages = stage_table(spark, results)
    return stages, run_summary(stages, len(STAGES))


def retrain_batch_writer(sf_dir: str, root: str, candidates: list[str] | None = None):
    """T11 + G8: a foreachBatch function over ``retrain_stream``: every accepted verdict runs the stages once, under a run id
    made from its pipeline and trigger, so a replayed micro-batch finds finished runs by their marks."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for r in batch.where("accepted").orderBy("ts", "trigger_id").collect():        # at most one a cooldown and pipeline
            run_id = f"{r['pipeline']}-{r['trigger_id']}"
            _, summary = run_pipeline(spark, sf_dir, root, candidates, run_id=run_id)
            if summary.first()["all_passed"]:
                audit_append(spark, f"{root}/audit", "retrain_finished", {"run_id": run_id, "batch_id": batch_id})
    return fn


def retrain_if_drifted(spark: SparkSession, sf_dir: str, root: str, verdicts: DataFrame,
                       cooldown_s: int = RETRAIN_COOLDOWN_S, candidates: list[str] | None = None) -> DataFrame:
    """Drift verdicts (trigger_id, ts, retrain) through the cooldown; each verdict that passes
    runs the stages once.  Returns (trigger_id, ts, retrain, started) as decided and written."""
    path = f"{root}/retrain_decisions/{uuid.uuid4().hex}"
    retrain_decisions(verdicts, cooldown_s).write.parquet(path)
    decided = spark.read.parquet(path)
    for r in decided.where("started").orderBy("ts").collect():      # at most one a cooldown
        audit_append(spark, f"{root}/audit", "retrain_started", {"trigger": str(r["trigger_id"])})
        run_pipeline(spark, sf_dir, root, candidates)
    return decided
