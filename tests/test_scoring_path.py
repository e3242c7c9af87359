"""One scoring path: batch equals stream, the registry decides the model, bad rows come out with reasons."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trialframe.functions.recipe import FEATURE_COLS, engineer_features, fit_scale
from trialframe.ml.qualify import qualify, report
from trialframe.ml.train import append_run, build_pipeline, candidates, load_scorer, run_log_row, save_model, scale_values, score, with_label
from trialframe.plans.fixtures import shifted_production
from trialframe.sources.store import REGISTRY_SCHEMA, current_model, read_registry, register_model, registry_entry
from trialframe.sources.tables import read_report, trials, write_report
from trialframe.streaming.streams import run_foreach_batch, scoring_batch_writer, table_stream

AT = "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    """Two saved models that differ in their scale, and the raw rows."""
    base = str(tmp_path_factory.mktemp("models"))
    t = shifted_production(trials(spark, SF_SMALL))
    ref = t.filter(F.col("side") == "reference")
    scale = scale_values(fit_scale(ref))
    feats = engineer_features(ref, scale=scale).cache()
    model = build_pipeline(candidates(feats.count())["logistic_regression"]()).fit(with_label(feats))
    save_model(model, f"{base}/one", scale, name="logistic_regression", metrics={"f1_score": 0.9}, trained_at=AT, run_id="r1")
    save_model(model, f"{base}/two", {k: v * 3 for k, v in scale.items()}, name="logistic_regression",
               metrics={"f1_score": 0.8}, trained_at=AT, run_id="r2")
    return base, t, feats, scale


def test_saved_scale_and_inputs_come_back(spark, models):
    base, _, _, scale = models
    scorer = load_scorer(spark, f"{base}/one")
    assert scorer.scale == pytest.approx(scale) and scorer.feature_columns == FEATURE_COLS
    assert scorer.metadata["metrics"] == {"f1_score": 0.9} and scorer.metadata["run_id"] == "r1"


def test_every_row_comes_out_and_bad_ones_with_reasons(spark, models):
    base, t, _, _ = models
    rows = t.filter(F.col("side") == "production").withColumn(
        "patient_age", F.when(F.pmod(F.xxhash64("row_key"), F.lit(7)) == 0, 200).otherwise(F.col("patient_age")))
    out = score(load_scorer(spark, f"{base}/one"), rows, AT)
    assert out.count() == rows.count()
    bad = out.where("prediction is null")
    assert bad.count() and bad.where("size(violations) = 0").count() == 0
    assert out.where("prediction is not null and size(violations) > 0").count() == 0
    assert bad.where(F.array_contains("violations", "patient_age: out of range [18, 100]")).count()


def entry(spark, base, version, name, at):
    return registry_entry(spark, model_name="m", version=version, model="logistic_regression", registered_at=at,
                          model_path=f"{base}/{name}", qualified_for_production=True, feature_columns=FEATURE_COLS)


def test_stream_equals_batch_and_a_new_version_is_picked_up(spark, models, tmp_path):
    base, t, _, _ = models
    root, out = f"{tmp_path}/root", f"{tmp_path}/out"
    register_model(spark, root, entry(spark, base, "1", "one", "2024-01-01 00:00:00"))
    writer = scoring_batch_writer(root, out, AT)
    rows = shifted_production(trials(spark, SF_SMALL, lineitem=table_stream(spark, SF_SMALL, "lineitem")))
    run_foreach_batch(rows, writer, f"{tmp_path}/checkpoint")
    streamed = spark.read.parquet(out).drop("batch_id", "model_version")
    batch = score(load_scorer(spark, f"{base}/one"), t, AT)
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).count() == 0
    register_model(spark, root, entry(spark, base, "2", "two", "2024-01-02 00:00:00"))
    writer(t, 77)                                       # the next micro-batch
    after = spark.read.parquet(out).where("batch_id = 77")
    assert {r.model_version for r in after.select("model_version").distinct().collect()} == {2} or \
        {str(r.model_version) for r in after.select("model_version").distinct().collect()} == {"2"}
    second = score(load_scorer(spark, f"{base}/two"), t, AT)
    assert after.drop("batch_id", "model_version").exceptAll(second).count() == 0


def test_registry_entry_has_all_fields(spark, tmp_path):
    register_model(spark, str(tmp_path), entry(spark, "/m", "1", "one", AT))
    got = read_registry(spark, str(tmp_path))
    assert len(got.columns) == 13 == len(REGISTRY_SCHEMA.split(", ")) and current_model(got).first().version == "1"
    with pytest.raises(ValueError, match="unqualified"):
        register_model(spark, str(tmp_path), registry_entry(spark, model_name="m", version="2"))
    with pytest.raises(ValueError, match="no such"):
        registry_entry(spark, colour="red")


def test_qualification_report_round_trip(spark, models, tmp_path):
    base, t, feats, scale = models
    prod = engineer_features(t.filter(F.col("side") == "production"), scale=scale)
    checks = qualify(spark, f"{base}/one", feats, prod)
    names = {(r.stage, r.check): r.passed for r in checks.collect()}
    assert names[("IQ", "metadata_complete")] and names[("IQ", "feature_columns")] and names[("OQ", "feature_count")]
    whole = report(checks)
    write_report(whole, f"{tmp_path}/report")
    back = read_report(spark, f"{tmp_path}/report", whole.schema).first()
    assert {c.check for c in back.iq.checks} == {k for s, k in names if s == "IQ"}
    assert back.overall_qualification_status == whole.first().overall_qualification_status
    missing = {r.check: r.passed for r in qualify(spark, f"{base}/none", feats, prod).collect()}
    assert missing == {"model_path_exists": False, "model_loads": False}


def test_run_log(spark, tmp_path):
    for i in range(3):
        append_run(run_log_row(spark, f"r{i}", "m", {"depth": i}, {"f1": i / 10}, AT), str(tmp_path))
    rows = {r.run_id: r for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert len(rows) == 3 and rows["r2"].params == {"depth": "2"} and rows["r2"].metrics == {"f1": 0.2}


def test_forest_keeps_node_ids_and_grows_the_same_trees(spark):
    """Every level walked all trees from their roots for each row."""
    from pyspark.ml.feature import VectorAssembler
    rows = spark.range(0, 600, 1, 2).select(
        (F.xxhash64("id") % 50).cast("double").alias("a"), (F.xxhash64("id", F.lit(1)) % 7).cast("double").alias("b"),
        (F.xxhash64("id", F.lit(2)) % 300).cast("double").alias("c"), F.col("id"))
    rows = rows.withColumn("label", (F.col("a") * F.col("b") + F.col("id") % 11 > 20).cast("double"))
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows).select("label", "features").cache()
    forest = candidates(600)["random_forest"]()
    assert forest.getCacheNodeIds()
    kept, walked = (forest.copy({forest.cacheNodeIds: c}).fit(vectors).toDebugString.split("\n", 1)[1] for c in (True, False))
    assert kept == walked
    vectors.unpersist()
