"""A few groups hold all rows: no task may get a whole group, whatever the planner's broadcast threshold."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trialframe.functions.recipe import engineer_features
from trialframe.operators.prefix import running_totals
from trialframe.operators.quality import Check, run_suite
from trialframe.operators.split import stratified_split
from trialframe.plans.q_ml import training_sets
from trialframe.sources.tables import read_table, trials


@pytest.fixture()
def no_broadcast(spark):
    """Only hinted broadcasts."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_side_maxima_are_not_joined_by_side(spark, no_broadcast):
    t = trials(spark, SF_SMALL).select("side", "row_key", "mol_weight", "logp", "tpsa", "hbd", "hba", "rotatable_bonds", "patient_age",
                                       "patient_weight_kg", "creatinine_clearance", "baseline_crp", "baseline_il6", "baseline_tnfa",
                                       "dose_mg", "treatment_days").localCheckpoint()
    out = engineer_features(t, scale="batch", by="side")
    assert "SortMergeJoin" not in plan_of(out) and out.count() == t.count()


def test_split_cutoffs_are_not_joined_by_label(spark, no_broadcast):
    rows = spark.range(1_000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 2).alias("label")).localCheckpoint()
    out = stratified_split(rows, "id", "label", 0.2, 42)
    assert "SortMergeJoin" not in plan_of(out)
    assert {(r.label, r.n, r.t) for r in out.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()} == {
        (None, 100, 20), (0, 400, 80), (1, 500, 100)}


def test_range_cuts_are_not_joined_by_key(spark, no_broadcast):
    rows = spark.range(4_000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"), F.lit(1).cast("long").alias("c"))
    out = running_totals(rows, "v", ["c"], keys=["k"])
    assert "BroadcastHashJoin" in plan_of(out)
    assert out.where(F.col("cum_c") != F.floor(F.col("v") / 2) + 1).count() == 0 and out.count() == 4_000


def test_suite_reads_the_table_twice(spark):
    plan = plan_of(run_suite(read_table(spark, SF_SMALL, "lineitem").select(F.col("l_orderkey").alias("sample_id"), F.col("l_tax").alias("dose_mg")),
                             [Check("ids", "unique", "sample_id"), Check("doses", "isin", "dose_mg", {"values": [0.0]}), Check("rows", "min_rows", None, {"n": 1})]))
    assert plan.count("FileScan parquet") == 2


def test_lines_are_shuffled_twice_for_the_trial_view(spark, no_broadcast):
    lines = plan_of(trials(spark, SF_SMALL)).splitlines()
    depth = {c: next(line.index("SortMergeJoin") for line in lines if f"SortMergeJoin [{c}#" in line) for c in ("o_custkey", "l_orderkey")}
    assert depth["o_custkey"] > depth["l_orderkey"]
    assert "l_linenumber" not in next("".join(lines[i:]) for i, line in enumerate(lines) if "SortMergeJoin [o_custkey#" in line)


def test_training_sets_are_read_from_files_and_split_by_a_broadcast(spark, no_broadcast):
    sets = training_sets(spark, SF_SMALL)
    assert training_sets(spark, SF_SMALL) is sets
    for part in sets[:4]:
        plan = plan_of(part)
        assert "lineitem" not in plan and "SortMergeJoin" not in plan
    t = trials(spark, SF_SMALL)
    assert sets[0].count() + sets[1].count() == t.where("side = 'reference'").count() and sets[3].count() == t.where("side = 'production'").count()
