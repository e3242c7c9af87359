"""Qualification of a trained model (G2-G6): installation, operational and
performance checks as a table of check rows plus an overall verdict.

OQ metrics come from one aggregate over the scored test split; PQ from one
aggregate over the scored production side.  Only the one-row results are
read on the driver (to decide the gate).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.functions.recipe import FEATURE_COLS
from trialframe.ml.train import LABEL, load_scorer, positive_probability
from trialframe.operators.evaluate import classification_metrics, score_spread
from trialframe.sources.tables import table_exists

# Qualification thresholds.
MIN_ACCURACY, MIN_PRECISION, MIN_RECALL, MIN_F1 = 0.75, 0.70, 0.70, 0.72
MIN_RATE, MAX_RATE = 0.05, 0.97
MIN_PROB_STD = 0.05
MAX_MS_PER_100 = 5000.0


class NotQualifiedError(RuntimeError):
    pass


def qualify(spark: SparkSession, model_path: str, test: DataFrame, production: DataFrame) -> DataFrame:
    """(stage, check, passed, detail) rows; stage in IQ / OQ / PQ."""
    rows = []
    exists = table_exists(spark, model_path)
    rows.append(("IQ", "model_path_exists", exists, model_path))
    scorer = None
    try:
        scorer = load_scorer(spark, model_path)
        rows.append(("IQ", "model_loads", True, type(scorer.model.stages[-1]).__name__))
    except Exception as e:  # noqa: BLE001 - the failure is the check result
        rows.append(("IQ", "model_loads", False, str(e)))
    if scorer is not None:
        model, last, meta = scorer.model, scorer.model.stages[-1], scorer.metadata
        missing = [k for k in ("model", "trained_at", "feature_columns", "scale", "metrics") if not meta.get(k)]
        rows.append(("IQ", "metadata_complete", not missing, f"missing {missing}"))
        rows.append(("IQ", "feature_columns", scorer.feature_columns == FEATURE_COLS, f"{len(scorer.feature_columns)} columns"))
        rows.append(("IQ", "has_predict", last.hasParam("predictionCol"), "predictionCol"))
        rows.append(("IQ", "has_probability", last.hasParam("probabilityCol"), "probabilityCol"))
        n_inputs = len(model.stages[0].getInputCols())
        rows.append(("OQ", "feature_count", n_inputs == len(FEATURE_COLS), f"{n_inputs} of {len(FEATURE_COLS)}"))
        production = production.cache()
        st = positive_probability(model.transform(test.withColumn("label", F.col(LABEL).cast("double"))))
        st = st.withColumn("prediction", F.col("prediction").cast("int"))
        m = classification_metrics(st, LABEL, "prediction").crossJoin(
            score_spread(st, "prediction", "p1").select("prediction_variance")).first()
        for name, thr in (("accuracy", MIN_ACCURACY), ("precision", MIN_PRECISION),
                          ("recall", MIN_RECALL), ("f1_score", MIN_F1)):
            rows.append(("OQ", f"{name}_threshold", bool(m[name] >= thr), f"{m[name]} >= {thr}"))
        rows.append(("OQ", "prediction_variance", bool((m["prediction_variance"] or 0) > 0),
                     f"{m['prediction_variance']}"))
        sp = positive_probability(model.transform(production)).withColumn(
            "prediction", F.col("prediction").cast("int"))
        p = score_spread(sp, "prediction", "p1").first()
        rate = p["positive_rate"]
        rows.append(("PQ", "production_rate_in_bounds", rate is not None and MIN_RATE <= rate <= MAX_RATE,
                     f"{rate} in [{MIN_RATE}, {MAX_RATE}]"))
        rows.append(("PQ", "probability_spread", (p["probability_std"] or 0) > MIN_PROB_STD,
                     f"{p['probability_std']} > {MIN_PROB_STD}"))
        rows.append(("PQ", "no_nan_predictions", p["nan_predictions"] == 0, f"{p['nan_predictions']}"))
        t0 = time.perf_counter()
        model.transform(production.limit(100)).select("prediction", "probability").collect()
        ms = (time.perf_counter() - t0) * 1000
        rows.append(("PQ", "latency_100_rows", ms < MAX_MS_PER_100, f"limit {MAX_MS_PER_100:.0f} ms"))
        production.unpersist()
    return spark.createDataFrame(rows, "stage string, check string, passed boolean, detail string")


def verdict(checks: DataFrame) -> DataFrame:
    """Per-stage and overall QUALIFIED / NOT QUALIFIED (one row)."""
    ok = lambda s: F.coalesce(F.bool_and(F.when(F.col("stage") == s, F.col("passed"))), F.lit(False))
    v = checks.agg(ok("IQ").alias("iq"), ok("OQ").alias("oq"), ok("PQ").alias("pq"))
    status = F.when(F.col("iq") & F.col("oq") & F.col("pq"), F.lit("QUALIFIED")).otherwise(F.lit("NOT QUALIFIED"))
    return v.withColumn("overall_qualification_status", status)


def report(checks: DataFrame) -> DataFrame:
    """One nested row: per stage the verdict and its checks, and the overall status."""
    stage = lambda s: F.array_sort(F.collect_list(F.when(F.col("stage") == s, F.struct("check", "passed", "detail"))))
    parts = checks.agg(*[stage(s).alias(f"{s.lower()}_checks") for s in ("IQ", "OQ", "PQ")])        # a dozen checks
    return parts.crossJoin(verdict(checks)).select(
        *[F.struct(F.col(s).alias("passed"), F.col(f"{s}_checks").alias("checks")).alias(s) for s in ("iq", "oq", "pq")],
        "overall_qualification_status")


def gate(checks: DataFrame) -> dict:
    """G5/G6 gate: raise unless qualified."""
    v = verdict(checks).first().asDict()
    if v["overall_qualification_status"] != "QUALIFIED":
        raise NotQualifiedError(str(v))
    return v
