"""Queries: KS drift per column, drift verdict, second test, windowed drift.

Input: the trial table with the production side shifted (age x1.1, crp x1.4)
and features computed per side (each side is its own batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trialframe.functions.recipe import engineer_features
from trialframe.operators.drift import (
    CATEGORICAL, EXACT_MAX, MAX_DRIFT_SHARE, MONITOR_FEATURES, P_THRESHOLD, WASSERSTEIN_THRESHOLD, chi_square_critical,
    drift_summary, ks_pvalue_sql, ks_statistics, ranked, second_test, second_test_summary, windowed_ks)
from trialframe.plans.catalog import r6, register, rnd
from trialframe.plans.fixtures import shifted_production, shifted_production_sql
from trialframe.plans.oracle import with_trials
from trialframe.plans.q_features import features_sql
from trialframe.sources.tables import read_table, trials


def drift_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    f = drift_table(spark, sf_dir)
    return f.filter(F.col("side") == "reference"), f.filter(F.col("side") == "production")


def drift_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides in one table (scanned once); ``side`` tells them apart."""
    f = engineer_features(shifted_production(trials(spark, sf_dir)), scale="batch", by="side")
    return f.select("side", *MONITOR_FEATURES)


def is_ref():
    return F.col("side") == "reference"


_LONG = " UNION ALL ".join(
    f"SELECT {i} AS ord, '{c}' AS \"column\", side, CAST({c} AS DOUBLE) AS value FROM feat WHERE {c} IS NOT NULL"
    for i, c in enumerate(MONITOR_FEATURES))

_DRIFT_CTES = f"""shifted AS ({shifted_production_sql('trials')}),
feat AS ({features_sql('shifted', 'batch', by='side')}),
long AS ({_LONG}),
g AS (SELECT ord, "column", value, count(*) FILTER (WHERE side = 'reference') AS n_ref,
             count(*) FILTER (WHERE side = 'production') AS n_cur FROM long GROUP BY ALL),
c AS (SELECT *, sum(n_ref) OVER (PARTITION BY "column" ORDER BY value) AS cum_ref,
                sum(n_cur) OVER (PARTITION BY "column" ORDER BY value) AS cum_cur FROM g),
t AS (SELECT "column", sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur FROM g GROUP BY 1),
d AS (SELECT ord, "column", tot_ref, tot_cur, max(abs(cum_ref / tot_ref - cum_cur / tot_cur)) AS d
      FROM c JOIN t USING ("column") GROUP BY ALL),
ks AS (SELECT ord, "column",
         CASE WHEN tot_ref > 1 AND tot_cur > 1 THEN d END AS d,
         CASE WHEN tot_ref > 1 AND tot_cur > 1 THEN {ks_pvalue_sql('d', 'tot_ref', 'tot_cur')} END AS p,
         CAST(tot_ref AS BIGINT) AS n_ref, CAST(tot_cur AS BIGINT) AS n_cur FROM d)"""


@register("ks_drift", with_trials(f"""
SELECT ord, "column", ROUND(d, 4) + 0e0 AS ks_statistic, ROUND(p, 4) + 0e0 AS p_value,
       COALESCE(p < {P_THRESHOLD}, false) AS drifted, n_ref, n_cur,
       CASE WHEN p IS NULL THEN NULL WHEN greatest(n_ref, n_cur) <= {EXACT_MAX} THEN 'ks_exact' ELSE 'ks_asymptotic' END AS method
FROM ks""", extra_ctes=_DRIFT_CTES))
def ks_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + D2: two-sample KS per monitored column, reference vs shifted production."""
    k = ks_statistics(drift_table(spark, sf_dir), None, places=None, side=is_ref(), exact=True)
    return k.withColumns({"ks_statistic": rnd("ks_statistic", 4), "p_value": rnd("p_value", 4)})


@register("drift_ranked", with_trials("""
SELECT row_number() OVER (ORDER BY d DESC NULLS LAST, "column") AS place, "column", ROUND(d, 4) + 0e0 AS ks_statistic FROM ks""",
                                     extra_ctes=_DRIFT_CTES))
def drift_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the monitored columns by KS statistic, largest first."""
    k = ranked(ks_statistics(drift_table(spark, sf_dir), None, places=None, side=is_ref()))
    w = Window.orderBy(F.desc_nulls_last("ks_statistic"), "column")         # one row per monitored column
    return k.select(F.row_number().over(w).cast("long").alias("place"), "column", rnd("ks_statistic", 4).alias("ks_statistic"))


@register("drift_summary", with_trials(f"""
SELECT n_drifted_features, n_total_features,
       ROUND(share, 4) + 0e0 AS share_drifted_features,
       drifted_columns, n_drifted_features > 0 AS dataset_drift_detected,
       n_drifted_features > 0 OR share > {MAX_DRIFT_SHARE} AS alert,
       n_drifted_features > 0 AND share > {MAX_DRIFT_SHARE} AS retrain,
       (SELECT CAST(count(*) AS BIGINT) FROM trials WHERE side = 'reference') AS n_reference_samples,
       (SELECT CAST(count(*) AS BIGINT) FROM trials WHERE side = 'production') AS n_current_samples
FROM (SELECT CAST(count(*) FILTER (WHERE COALESCE(p < {P_THRESHOLD}, false)) AS BIGINT) AS n_drifted_features,
             CAST(count(*) AS BIGINT) AS n_total_features,
             count(*) FILTER (WHERE COALESCE(p < {P_THRESHOLD}, false)) / count(*) AS share,
             array_to_string(list("column" ORDER BY ord) FILTER (WHERE COALESCE(p < {P_THRESHOLD}, false)), ',') AS drifted_columns
      FROM ks) s""", extra_ctes=_DRIFT_CTES))
def drift_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 + D6 + D7: dataset verdict, alert (or) and retrain (and) decisions."""
    t = drift_table(spark, sf_dir)
    per = ks_statistics(t, None, side=is_ref(), exact=True)
    n = trials(spark, sf_dir).agg(F.count_if(is_ref()).cast("long").alias("n_reference_samples"),
              F.count_if(~is_ref()).cast("long").alias("n_current_samples"))
    s = drift_summary(per, 0, 0).drop("n_reference_samples", "n_current_samples").crossJoin(n)
    return s.select("n_drifted_features", "n_total_features", rnd("share_drifted_features", 4).alias(
        "share_drifted_features"), F.array_join("drifted_columns", ",").alias("drifted_columns"),
        "dataset_drift_detected", "alert", "retrain", "n_reference_samples", "n_current_samples")


_CRIT = "[" + ", ".join(f"{chi_square_critical(k)!r}e0" for k in range(1, 20)) + "]"
_LISTED = "(" + ", ".join(f"'{c}'" for c in CATEGORICAL) + ")"


_SECOND_SQL = f"""
SELECT "column", test, ROUND(statistic, 6) + 0e0 AS statistic, ROUND(threshold, 6) + 0e0 AS threshold, drifted
FROM (
  SELECT g."column", 'chi_square' AS test,
    CASE WHEN count(*) FILTER (WHERE n_ref = 0 AND n_cur > 0) = 0 THEN
      sum(CASE WHEN n_ref > 0 THEN (n_cur - n_ref * (tot_cur / tot_ref)) ^ 2 / (n_ref * (tot_cur / tot_ref)) END) END AS statistic,
    {_CRIT}[GREATEST(max(k_ref) - 1, 1)] AS threshold,
    count(*) FILTER (WHERE n_ref = 0 AND n_cur > 0) > 0
      OR COALESCE(sum(CASE WHEN n_ref > 0 THEN (n_cur - n_ref * (tot_cur / tot_ref)) ^ 2 / (n_ref * (tot_cur / tot_ref)) END)
                  > {_CRIT}[GREATEST(max(k_ref) - 1, 1)], false) AS drifted
  FROM g JOIN t USING ("column") JOIN k USING ("column")
  WHERE g."column" IN {_LISTED} GROUP BY g."column"
  UNION ALL
  SELECT "column", 'wasserstein_norm', w1 / std_ref, {WASSERSTEIN_THRESHOLD}e0, COALESCE(w1 / std_ref > {WASSERSTEIN_THRESHOLD}, false)
  FROM (SELECT "column", std_ref,
          COALESCE(sum(abs(cum_ref / tot_ref - cum_cur / tot_cur) * (next_value - value)), 0e0) AS w1
        FROM (SELECT *, lead(value) OVER (PARTITION BY "column" ORDER BY value) AS next_value FROM c) c2
        JOIN t USING ("column") JOIN k USING ("column")
        WHERE "column" NOT IN {_LISTED} GROUP BY "column", std_ref) w
) x"""
_SECOND_CTES = _DRIFT_CTES + """,
k AS (SELECT "column", count(*) FILTER (WHERE n_ref > 0) AS k_ref,
        sqrt(greatest(sum(value * value * n_ref) / sum(n_ref) - (sum(value * n_ref) / sum(n_ref)) ^ 2, 0e0)) AS std_ref
      FROM g GROUP BY 1)"""


@register("second_drift_test", with_trials(_SECOND_SQL, extra_ctes=_SECOND_CTES))
def second_drift_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chi-square (declared categorical) or normed Wasserstein (others) per column."""
    s = second_test(drift_table(spark, sf_dir), None, side=is_ref())
    return s.select("column", "test", r6("statistic").alias("statistic"), r6("threshold").alias("threshold"),
                    "drifted")


@register("second_drift_summary", with_trials(f"""
SELECT count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted,
       ROUND(count(*) FILTER (WHERE drifted) / count(*), 6) + 0e0 AS share_drifted,
       count(*) FILTER (WHERE drifted) / count(*) > {MAX_DRIFT_SHARE} AS dataset_drift
FROM ({_SECOND_SQL}) per""", extra_ctes=_SECOND_CTES))
def second_drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 for the dataset: how many columns the second test calls drifted, and their share."""
    return second_test_summary(second_test(drift_table(spark, sf_dir), None, side=is_ref())).withColumn(
        "share_drifted", r6("share_drifted"))


_WEEK_SPLIT = "2024-01-08"


def _drift_windows_sql(window: str, name: str) -> str:
    """KS of the events before the split against each later time slice ``window``."""
    return f"""
WITH ref AS (SELECT value AS v FROM events WHERE ts < TIMESTAMP '{_WEEK_SPLIT}' AND value IS NOT NULL),
cur AS (SELECT {window} AS w, value AS v FROM events
        WHERE ts >= TIMESTAMP '{_WEEK_SPLIT}' AND value IS NOT NULL),
wins AS (SELECT DISTINCT w FROM cur),
long AS (SELECT w, v, 1 AS r, 0 AS c FROM wins, ref UNION ALL SELECT w, v, 0, 1 FROM cur),
g AS (SELECT w, v, sum(r) AS n_ref, sum(c) AS n_cur FROM long GROUP BY ALL),
cc AS (SELECT *, sum(n_ref) OVER (PARTITION BY w ORDER BY v) AS cr,
                 sum(n_cur) OVER (PARTITION BY w ORDER BY v) AS ccur FROM g),
t AS (SELECT w, sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur FROM g GROUP BY w),
d AS (SELECT w, tot_ref, tot_cur, max(abs(cr / tot_ref - ccur / tot_cur)) AS d FROM cc JOIN t USING (w) GROUP BY ALL)
SELECT w AS {name}, ROUND(d, 4) + 0e0 AS ks_statistic,
       ROUND({ks_pvalue_sql('d', 'tot_ref', 'tot_cur')}, 4) + 0e0 AS p_value,
       {ks_pvalue_sql('d', 'tot_ref', 'tot_cur')} < {P_THRESHOLD} AS drifted,
       CAST(tot_ref AS BIGINT) AS n_ref, CAST(tot_cur AS BIGINT) AS n_cur
FROM d"""


@register("drift_by_window", _drift_windows_sql("CAST(date_trunc('week', ts) AS DATE)", "week_start"))
def drift_by_window(spark: SparkSession, sf_dir: str, split: str = _WEEK_SPLIT) -> DataFrame:
    """Events before ``split`` are the reference; each later week is tested against them."""
    ev = read_table(spark, sf_dir, "events")
    ref = ev.filter(F.col("ts") < F.lit(split).cast("timestamp_ntz"))
    cur = ev.filter(F.col("ts") >= F.lit(split).cast("timestamp_ntz")).withColumn(
        "week_start", F.to_date(F.date_trunc("week", F.col("ts"))))
    k = windowed_ks(ref, cur, "value", "week_start", places=None)
    return k.withColumns({"ks_statistic": rnd("ks_statistic", 4), "p_value": rnd("p_value", 4)})
