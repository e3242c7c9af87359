"""Column operators, feature recipe and the quality suite (fault injection)."""

import pytest
from pyspark.sql import functions as F

from trialframe.functions.columns import bucket_case, clip, confidence_band
from trialframe.functions.recipe import DERIVED_COLS, FIXED_SCALE, engineer_features
from trialframe.operators.contract import MissingColumnsError, require_columns, validate_contract
from trialframe.operators.quality import QualityGateError, gate, run_suite, suite_summary
from trialframe.sources.tables import RAW_COLUMNS, trials

from conftest import SF_SMALL


def _raw(spark):
    return trials(spark, SF_SMALL).select(*RAW_COLUMNS)


def test_clip_keeps_null_and_bounds(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (5.0,), (50.0,)], "x double")
    out = [r[0] for r in df.select(clip("x", 0, 10)).collect()]
    assert out == [None, 0.0, 5.0, 10.0]


def test_bucket_case_and_bands(spark):
    df = spark.createDataFrame([(20.0, 0.9), (40.0, 0.3), (70.0, 0.55), (None, 0.61)], "age double, p double")
    r = df.select(bucket_case("age", [("<", 30.0, 1.2), (">", 65.0, 0.7)], 1.0).alias("f"),
                  confidence_band("p").alias("b")).collect()
    assert [x.f for x in r] == [1.2, 1.0, 0.7, 1.0]
    assert [x.b for x in r] == ["high", "medium", "low", "medium"]


def test_drug_like_hand_case(spark):
    # mw 300, logp 2, hbd 1, hba 4 -> no violations, drug-like
    row = dict(mol_weight=300.0, logp=2.0, tpsa=65.0, hbd=1.0, hba=4.0, rotatable_bonds=4.0,
               aromatic_rings=2.0, patient_age=45.0, patient_weight_kg=72.0, creatinine_clearance=90.0,
               is_male=1.0, baseline_crp=4.0, baseline_il6=8.0, baseline_tnfa=12.0, baseline_wbc=7.0,
               dose_mg=100.0, treatment_days=30.0)
    df = spark.createDataFrame([row])
    f = engineer_features(df, scale="fixed").first()
    assert f.ro5_violations == 0 and f.is_drug_like == 1
    assert f.bioavailability_score == pytest.approx(1.0)
    assert f.inflammation_score == pytest.approx(4 / 80 * 0.4 + 8 / 200 * 0.35 + 12 / 300 * 0.25)
    assert f.renal_adjusted_dose == pytest.approx(100.0)
    assert f.age_metabolism_factor == 1.0


def test_features_no_new_nulls_and_bounds(spark):
    f = engineer_features(trials(spark, SF_SMALL), scale="batch")
    agg = f.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in DERIVED_COLS],
                F.min("inflammation_score").alias("imin"), F.max("inflammation_score").alias("imax"),
                F.max("renal_adjusted_dose").alias("rmax")).first()
    assert all(agg[c] == 0 for c in DERIVED_COLS)
    assert 0 <= agg.imin and agg.imax <= 1 and agg.rmax <= 800
    assert "ingestion_timestamp" not in f.columns


def test_batch_scale_differs_from_fixed(spark):
    t = trials(spark, SF_SMALL)
    b = engineer_features(t, scale="batch").select("row_key", F.col("inflammation_score").alias("b"))
    x = engineer_features(t, scale=FIXED_SCALE).select("row_key", F.col("inflammation_score").alias("x"))
    d = b.join(x, "row_key").agg(F.max(F.abs(F.col("b") - F.col("x")))).first()[0]
    assert d > 0


def test_valid_data_passes_most_checks(spark):
    s = suite_summary(run_suite(_raw(spark))).first()
    assert s.total_checks == 15 and s.failed <= 2


@pytest.mark.parametrize("fault,check", [
    (lambda d: d.withColumn("sample_id", F.when(F.col("treatment_days") < 20, None).otherwise(F.col("sample_id"))),
     "no_null_sample_ids"),
    (lambda d: d.withColumn("mol_weight", F.when(F.col("treatment_days") == 7, 99999.0).otherwise(F.col("mol_weight"))),
     "mol_weight_range"),
    (lambda d: d.withColumn("dose_mg", F.when(F.col("treatment_days") == 7, 999.0).otherwise(F.col("dose_mg"))),
     "dose_mg_valid_values"),
])
def test_fault_is_caught(spark, fault, check):
    r = {x.check: x.status for x in run_suite(fault(_raw(spark))).collect()}
    assert r[check] == "FAIL"


def test_broken_table_blocks_gate(spark):
    bad = _raw(spark).withColumns({c: F.lit(-1e9) for c in
                                   ["mol_weight", "logp", "patient_age", "dose_mg", "baseline_crp",
                                    "baseline_il6", "baseline_tnfa", "baseline_wbc", "treatment_days"]})
    with pytest.raises(QualityGateError):
        gate(run_suite(bad))


def test_empty_table_row_rules_pass(spark):
    empty = _raw(spark).limit(0)
    r = {x.check: x.status for x in run_suite(empty).collect()}
    assert r["mol_weight_range"] == "PASS" and r["minimum_sample_size"] == "FAIL"
    assert r["label_balance_not_extreme"] == "FAIL"


def test_contract_and_required_columns(spark):
    df = spark.createDataFrame([(1000.5, None)], "mol_weight double, dose_mg double")
    v = validate_contract(df).first()
    assert not v.is_valid
    assert "dose_mg: required" in v.violations and "mol_weight: out of range [50, 1000]" in v.violations
    assert v.creatinine_clearance == 90.0
    with pytest.raises(MissingColumnsError):
        require_columns(df, ["mol_weight", "logp"])
