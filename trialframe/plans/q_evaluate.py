"""Queries: confusion matrix, metrics, exact AUC, score spread, bands.

No model is needed: ``noise`` (the label's random term) serves as the score
and ``noise >= 0.5`` as the prediction, so the oracle is exact SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.functions.columns import confidence_band
from trialframe.operators.evaluate import classification_metrics, roc_auc, score_spread
from trialframe.plans.catalog import r6, register, rnd
from trialframe.plans.oracle import with_trials
from trialframe.sources.tables import read_table, trials


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trials(spark, sf_dir)
    return t.withColumn("prediction", (F.col("noise") >= 0.5).cast("int"))


_METRICS_SQL = """
SELECT {by} tp, fp, tn, fn,
  ROUND(CASE WHEN tp + fp + tn + fn = 0 THEN 0e0 ELSE (tp + tn) / (tp + fp + tn + fn) END, 4) + 0e0 AS accuracy,
  ROUND(CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / (tp + fp) END, 4) + 0e0 AS "precision",
  ROUND(CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / (tp + fn) END, 4) + 0e0 AS recall,
  ROUND(CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2 * tp / (2 * tp + fp + fn) END, 4) + 0e0 AS f1_score,
  ROUND(CASE WHEN tn + fp = 0 THEN 0e0 ELSE tn / (tn + fp) END, 4) + 0e0 AS specificity
FROM (SELECT {by}
        CAST(count(*) FILTER (WHERE {y} = 1 AND {p} = 1) AS BIGINT) AS tp,
        CAST(count(*) FILTER (WHERE {y} = 0 AND {p} = 1) AS BIGINT) AS fp,
        CAST(count(*) FILTER (WHERE {y} = 0 AND {p} = 0) AS BIGINT) AS tn,
        CAST(count(*) FILTER (WHERE {y} = 1 AND {p} = 0) AS BIGINT) AS fn
      FROM {src} {group}) c"""


def _round4(df: DataFrame) -> DataFrame:
    return df.withColumns({c: rnd(c, 4)
                           for c in ("accuracy", "precision", "recall", "f1_score", "specificity")})


@register("classification_metrics", with_trials(_METRICS_SQL.format(
    by="batch_id,", y="efficacy_label", p="CAST(noise >= 0.5 AS INTEGER)", src="trials",
    group="GROUP BY batch_id")))
def classification_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + A11 + A13 per batch: confusion counts and the four metrics + specificity."""
    m = classification_metrics(_scored(spark, sf_dir), "efficacy_label", "prediction", by=["batch_id"],
                               places=None)
    return _round4(m)


@register("label_agreement", _METRICS_SQL.format(
    by="", y="quality", p="(1 - toxic)", src="labels", group=""))
def label_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + A11 on the labels table: does 'not toxic' predict 'quality'?"""
    lab = read_table(spark, sf_dir, "labels").withColumn("not_toxic", F.lit(1) - F.col("toxic"))
    return _round4(classification_metrics(lab, "quality", "not_toxic", places=None))


_AUC_SQL = """
SELECT {by_out} CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
  ROUND(sum(pos * (cum_neg - neg + neg / 2e0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) + 0e0 AS roc_auc
FROM (
  SELECT *, sum(neg) OVER (PARTITION BY {part} ORDER BY noise) AS cum_neg
  FROM (SELECT {by_in} noise, count(*) FILTER (WHERE efficacy_label = 1) AS pos,
               count(*) FILTER (WHERE efficacy_label = 0) AS neg
        FROM trials GROUP BY {by_in} noise) g
) c {group}"""


@register("roc_auc_exact", with_trials(_AUC_SQL.format(
    by_out="side,", by_in="side,", part="side", group="GROUP BY side")))
def roc_auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact AUC with ties per side (bucketed prefix sum, no single-task window)."""
    a = roc_auc(trials(spark, sf_dir), "efficacy_label", "noise", by=["side"])
    return a.select("side", F.col("n_pos").cast("long"), F.col("n_neg").cast("long"),
                    r6("roc_auc").alias("roc_auc"))


@register("score_spread", with_trials("""
SELECT CAST(count(*) AS BIGINT) AS n,
  ROUND(var_pop(CAST(noise >= 0.5 AS INTEGER)), 6) + 0e0 AS prediction_variance,
  ROUND(stddev_pop(noise), 6) + 0e0 AS probability_std,
  CAST(count(*) FILTER (WHERE isnan(noise) OR noise IS NULL) AS BIGINT) AS nan_predictions,
  ROUND(avg(CAST(noise >= 0.5 AS INTEGER)), 6) + 0e0 AS positive_rate
FROM trials"""))
def score_spread_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 + A15 + A3: spread of predictions and probabilities."""
    s = score_spread(_scored(spark, sf_dir), "prediction", "noise")
    return s.select("n", r6("prediction_variance").alias("prediction_variance"),
                    r6("probability_std").alias("probability_std"), "nan_predictions",
                    r6("positive_rate").alias("positive_rate"))


@register("prediction_bands", with_trials("""
SELECT CAST(noise >= 0.5 AS INTEGER) AS prediction,
  CASE WHEN greatest(noise, 1e0 - noise) >= 0.8e0 THEN 'high'
       WHEN greatest(noise, 1e0 - noise) >= 0.6e0 THEN 'medium' ELSE 'low' END AS confidence,
  CAST(count(*) AS BIGINT) AS count
FROM trials GROUP BY 1, 2"""))
def prediction_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P22 + M12: prediction x confidence band counts."""
    s = _scored(spark, sf_dir).withColumn("confidence", confidence_band("noise"))
    return s.groupBy("prediction", "confidence").agg(F.count(F.lit(1)).cast("long").alias("count"))
