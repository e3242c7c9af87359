"""Queries: feature upsert, feature-set versions, model registry, file fingerprints."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.functions.recipe import engineer_features
from trialframe.operators.evaluate import classification_metrics
from trialframe.plans.catalog import r6, register
from trialframe.plans.oracle import with_trials
from trialframe.sources.store import (
    artifact_status, current_model, fingerprint_diff, fingerprints, latest_version, table_fingerprint, upsert)
from trialframe.sources.tables import DRIVER_TABLES, read_table, trials

T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


@register("feature_upsert", with_trials(f"""
SELECT row_key, version, created_at, ROUND(inflammation_score, 6) + 0e0 AS inflammation_score
FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key, version ORDER BY created_at DESC, seq DESC) AS rn
  FROM (
    SELECT row_key, 'v1' AS version, TIMESTAMP '{T1}' AS created_at, 0 AS seq,
           LEAST(GREATEST(baseline_crp / 80e0 * 0.4e0 + baseline_il6 / 200e0 * 0.35e0
                          + baseline_tnfa / 300e0 * 0.25e0, 0e0), 1e0) AS inflammation_score
    FROM trials WHERE side = 'reference'
    UNION ALL
    SELECT row_key, 'v1', TIMESTAMP '{T2}', 1,
           LEAST(GREATEST(baseline_crp / m_crp * 0.4e0 + baseline_il6 / m_il6 * 0.35e0
                          + baseline_tnfa / m_tnfa * 0.25e0, 0e0), 1e0)
    FROM trials, (SELECT max(baseline_crp) AS m_crp, max(baseline_il6) AS m_il6,
                         max(baseline_tnfa) AS m_tnfa FROM trials) m
  ) u
) r WHERE rn = 1"""))
def feature_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + W2: version v1 first holds the reference side (fixed scale); a later
    upsert of all rows (batch scale) replaces matching keys and adds the rest."""
    t = trials(spark, sf_dir)
    first = engineer_features(t.filter(F.col("side") == "reference"), scale="fixed").select(
        "row_key", F.lit("v1").alias("version"), F.lit(T1).cast("timestamp_ntz").alias("created_at"),
        "inflammation_score")
    second = engineer_features(t, scale="batch").select(
        "row_key", F.lit("v1").alias("version"), F.lit(T2).cast("timestamp_ntz").alias("created_at"),
        "inflammation_score")
    u = upsert(first, second, ["row_key", "version"])
    return u.select("row_key", "version", "created_at", r6("inflammation_score").alias("inflammation_score"))


_CATALOG_SQL = """
SELECT 'trial_features' AS name, batch_id AS version, max(ingestion_timestamp) AS created_at,
       CAST(count(*) AS BIGINT) AS n_samples, 16 AS n_features
FROM trials GROUP BY batch_id"""


@register("latest_version", with_trials(f"""
SELECT c.*, c.version = l.version AS is_latest
FROM ({_CATALOG_SQL}) c JOIN (SELECT name, arg_max(version, (created_at, version)) AS version
                              FROM ({_CATALOG_SQL}) x GROUP BY name) l USING (name)"""))
def latest_version_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + K5 + L7: one feature-set version per batch; the newest is flagged."""
    cat = trials(spark, sf_dir).groupBy("batch_id").agg(
        F.max("ingestion_timestamp").alias("created_at"), F.count(F.lit(1)).cast("long").alias("n_samples"))
    cat = cat.select(F.lit("trial_features").alias("name"), F.col("batch_id").alias("version"),
                     "created_at", "n_samples", F.lit(16).alias("n_features"))
    latest = latest_version(cat).select("name", F.col("version").alias("_latest"))
    return cat.join(latest, "name").withColumn("is_latest", F.col("version") == F.col("_latest")).drop("_latest")


@register("registry_current", with_trials("""
SELECT h.*, best_f1 >= 0.72 AS qualified_for_production,
       COALESCE(version = (SELECT arg_max(version, (registered_at, version)) FROM h WHERE best_f1 >= 0.72), false) AS is_current
FROM h""", extra_ctes="""h AS (
  SELECT 'drug_efficacy_classifier' AS model_name, batch_id AS version, max(ingestion_timestamp) AS registered_at,
         ROUND(CASE WHEN 2 * count(*) FILTER (WHERE efficacy_label = 1 AND noise >= 0.5)
                         + count(*) FILTER (WHERE efficacy_label = 0 AND noise >= 0.5)
                         + count(*) FILTER (WHERE efficacy_label = 1 AND noise < 0.5) = 0 THEN 0e0
                    ELSE 2 * count(*) FILTER (WHERE efficacy_label = 1 AND noise >= 0.5)
                         / (2 * count(*) FILTER (WHERE efficacy_label = 1 AND noise >= 0.5)
                            + count(*) FILTER (WHERE efficacy_label = 0 AND noise >= 0.5)
                            + count(*) FILTER (WHERE efficacy_label = 1 AND noise < 0.5)) END, 4) + 0e0 AS best_f1
  FROM trials GROUP BY batch_id)"""))
def registry_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + L4 + G6: registry history (one entry per batch, F1 of the noise rule)
    and the current pointer: the newest qualified entry."""
    t = trials(spark, sf_dir).withColumn("prediction", (F.col("noise") >= 0.5).cast("int"))
    m = classification_metrics(t, "efficacy_label", "prediction", by=["batch_id"], places=None)
    reg = t.groupBy("batch_id").agg(F.max("ingestion_timestamp").alias("registered_at"))
    h = m.join(reg, "batch_id").select(
        F.lit("drug_efficacy_classifier").alias("model_name"), F.col("batch_id").alias("version"),
        "registered_at", (F.round(F.col("f1_score") * 10000) / 10000 + F.lit(0.0)).alias("best_f1"))
    h = h.withColumn("qualified_for_production", F.col("best_f1") >= 0.72)
    cur = current_model(h).select("model_name", F.col("version").alias("_cur"))
    return (h.join(cur, "model_name", "left")
             .withColumn("is_current", F.coalesce(F.col("version") == F.col("_cur"), F.lit(False)))
             .drop("_cur"))


@register("fingerprints")
def fingerprints_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + L6: name, size and md5 (above 64 MB the line hash) of every table file."""
    return fingerprints(spark, sf_dir, "*.parquet").select("name", "size", "md5", "line_hash")


@register("fingerprint_diff")
def fingerprint_diff_q(spark: SparkSession, sf_dir: str, other: str | None = None) -> DataFrame:
    """Which table files differ between this directory and another (default: the smoke scale beside it)."""
    other = other or os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    return fingerprint_diff(fingerprints(spark, other, "*.parquet"), fingerprints(spark, sf_dir, "*.parquet"))


@register("artifact_status")
def artifact_status_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected tables with existence and size (contents are not read)."""
    return artifact_status(spark, sf_dir, [f"{t}.parquet" for t in DRIVER_TABLES]).select("name", "expected", "exists", "size")


@register("table_fingerprint")
def table_fingerprint_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 for large tables: row count and an order-free hash of the rows."""
    return table_fingerprint(read_table(spark, sf_dir, "events"))
