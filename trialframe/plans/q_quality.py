"""Queries: quality suite, null profile, duplicates, column stats, value counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.operators.drift import MONITOR_FEATURES
from trialframe.operators.profile import column_stats, compare_stats, null_profile, value_counts
from trialframe.operators.quality import TRIAL_CHECKS, check_values, duplicate_count, run_suite, suite_summary
from trialframe.plans.catalog import r6, register, rnd
from trialframe.plans.fixtures import (
    shifted_production, shifted_production_sql, with_faults, with_faults_sql, with_nulls, with_nulls_sql)
from trialframe.plans.oracle import with_trials
from trialframe.sources.tables import RAW_COLUMNS, read_table, trials

_RAW = ", ".join(RAW_COLUMNS)


def suite_sql(src: str) -> str:
    """The 15-check suite as SQL over relation ``src`` (raw columns only)."""
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in RAW_COLUMNS)
    fails = lambda pred: f"CAST(count(*) FILTER (WHERE NOT COALESCE({pred}, false)) AS DOUBLE)"
    obs, ok = {}, {}
    for chk in TRIAL_CHECKS:
        a, c = chk.args, chk.column
        if chk.kind == "not_null":
            obs[chk.name] = f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE)"
            ok[chk.name] = f"{obs[chk.name]} = 0"
        elif chk.kind == "null_rate":
            obs[chk.name] = f"CAST({nulls} AS DOUBLE) / (count(*) * {len(RAW_COLUMNS)})"
            ok[chk.name] = f"COALESCE({obs[chk.name]} < {a['below']}, false)"
        elif chk.kind == "range":
            obs[chk.name] = fails(f"{c} BETWEEN {a['lo']} AND {a['hi']}")
            ok[chk.name] = f"{obs[chk.name]} = 0"
        elif chk.kind == "isin":
            vals = ", ".join(repr(v) for v in a["values"])
            obs[chk.name] = fails(f"{c} IN ({vals})")
            ok[chk.name] = f"{obs[chk.name]} = 0"
        elif chk.kind == "mean_between":
            obs[chk.name] = f"avg(CAST({c} AS DOUBLE))"
            ok[chk.name] = f"COALESCE({obs[chk.name]} > {a['lo']} AND {obs[chk.name]} < {a['hi']}, false)"
        elif chk.kind == "min_rows":
            obs[chk.name] = "CAST(count(*) AS DOUBLE)"
            ok[chk.name] = f"count(*) >= {a['n']}"
        elif chk.kind == "rule":
            obs[chk.name] = fails(f"{c} {a['op']} {a['bound']}")
            ok[chk.name] = f"{obs[chk.name]} = 0"
        elif chk.kind == "unique":
            obs[chk.name] = f"(SELECT CAST(COALESCE(sum(n - 1), 0) AS DOUBLE) FROM (SELECT count(*) AS n FROM {src} GROUP BY {c}))"
            ok[chk.name] = f"{obs[chk.name]} = 0"
    parts = [f"SELECT {i} AS ord, '{chk.name}' AS \"check\", "
             f"CASE WHEN {ok[chk.name]} THEN 'PASS' ELSE 'FAIL' END AS status, "
             f"ROUND({obs[chk.name]}, 6) + 0e0 AS observed "
             f"FROM {'(SELECT 1) one' if chk.kind == 'unique' else src}"
             for i, chk in enumerate(TRIAL_CHECKS)]
    return "\nUNION ALL\n".join(parts)


def nulls_as_nan(df: DataFrame) -> DataFrame:
    """Null doubles as NaN, as files written by other tools hold them."""
    return df.withColumns({f.name: F.coalesce(F.col(f.name), F.lit(float("nan"))) for f in df.schema.fields
                           if f.dataType.typeName() == "double"})


def _suite(t: DataFrame) -> DataFrame:
    r = run_suite(t.select(*RAW_COLUMNS))
    return r.select("ord", "check", "status", r6("observed").alias("observed"))


@register("quality_suite", with_trials(suite_sql("trials")))
def quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A18 + Q1-Q15: the suite on the trial table (duplicates fail by design)."""
    return _suite(trials(spark, sf_dir))


@register("quality_suite_faults", with_trials(suite_sql("faulted"),
                                              extra_ctes=f"faulted AS ({with_faults_sql('trials')})"))
def quality_suite_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite on fault-injected rows: null ids, bad dose, ranges."""
    return _suite(with_faults(trials(spark, sf_dir)))


@register("check_values", with_trials(" UNION ALL ".join(
    f"SELECT '{c.name}' AS \"check\", CAST(CAST({c.column} AS DOUBLE) AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n "
    f"FROM faulted GROUP BY {c.column}" for c in TRIAL_CHECKS if c.kind == "isin"),
    extra_ctes=f"faulted AS ({with_faults_sql('trials')})"))
def check_values_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: every distinct value that the list checks met, as rows."""
    t = with_faults(trials(spark, sf_dir)).select(*[F.col(c.column).cast("double").alias(c.column) for c in TRIAL_CHECKS if c.kind == "isin"])
    return check_values(t)


@register("quality_suite_nan", with_trials(suite_sql("nans"), extra_ctes=f"nans AS ({with_nulls_sql('trials')})"))
def quality_suite_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite where missing numbers are NaN: the same verdicts as for nulls."""
    return _suite(nulls_as_nan(with_nulls(trials(spark, sf_dir))))


@register("quality_summary", with_trials(f"""
SELECT CAST(count(*) AS BIGINT) AS total_checks,
       CAST(count(*) FILTER (WHERE status = 'PASS') AS BIGINT) AS passed,
       CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS failed,
       ROUND(count(*) FILTER (WHERE status = 'PASS') / count(*), 6) + 0e0 AS pass_rate,
       count(*) FILTER (WHERE status = 'FAIL') > 3 AS gate_blocked
FROM ({suite_sql('faulted')}) s""", extra_ctes=f"faulted AS ({with_faults_sql('trials')})"))
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19 + G1: summary of the faulted suite and whether the gate blocks."""
    s = suite_summary(run_suite(with_faults(trials(spark, sf_dir)).select(*RAW_COLUMNS)))
    return s.select("total_checks", "passed", "failed", r6("pass_rate").alias("pass_rate"),
                    (F.col("failed") > 3).alias("gate_blocked"))


def _null_profile_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls, "
             f"ROUND(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) + 0e0 AS null_share FROM nulled"
             for c in RAW_COLUMNS]
    body = " UNION ALL ".join(parts)
    return with_trials(f"""
    SELECT * FROM ({body}) p
    UNION ALL
    SELECT '*', CAST(sum(nulls) AS BIGINT), ROUND(avg(null_share_raw), 6) + 0e0
    FROM ({" UNION ALL ".join(
        f"SELECT count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) FILTER (WHERE {c} IS NULL) / count(*) AS null_share_raw FROM nulled"
        for c in RAW_COLUMNS)}) q""", extra_ctes=f"nulled AS ({with_nulls_sql('trials')})")


@register("null_profile", _null_profile_sql())
def null_profile_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A2: nulls per column and the mean null share (row ``*``)."""
    p = null_profile(with_nulls(trials(spark, sf_dir)).select(*RAW_COLUMNS))
    return p.select("column", "nulls", r6("null_share").alias("null_share"))


@register("null_profile_nan", _null_profile_sql())
def null_profile_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where missing numbers are NaN."""
    p = null_profile(nulls_as_nan(with_nulls(trials(spark, sf_dir))).select(*RAW_COLUMNS))
    return p.select("column", "nulls", r6("null_share").alias("null_share"))


@register("duplicate_keys", with_trials("""
SELECT CAST(count(*) AS BIGINT) AS distinct_ids, CAST(sum(n) AS BIGINT) AS n_rows,
       CAST(sum(n - 1) AS BIGINT) AS duplicates, CAST(max(n) AS BIGINT) AS max_copies
FROM (SELECT sample_id, count(*) AS n FROM trials GROUP BY sample_id) g"""))
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: duplicate sample ids (one shuffle on the id, map-side partial counts)."""
    g = trials(spark, sf_dir).groupBy("sample_id").count()
    return g.agg(F.count(F.lit(1)).cast("long").alias("distinct_ids"),
                 F.sum("count").cast("long").alias("n_rows"),
                 F.sum(F.col("count") - 1).cast("long").alias("duplicates"),
                 F.max("count").cast("long").alias("max_copies"))


def _stack_sql(src: str, cols: list[str], keep: str = "") -> str:
    k = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {k}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {src} WHERE {c} IS NOT NULL"
        for c in cols)


_STAT_COLS = [c for c in MONITOR_FEATURES if c not in ("bioavailability_score", "inflammation_score")] + ["is_male", "hbd"]


@register("column_stats", with_trials(f"""
SELECT side, "column", ROUND(avg(value), 3) + 0e0 AS mean, ROUND(stddev_samp(value), 3) + 0e0 AS std,
       ROUND(min(value), 3) + 0e0 AS min, ROUND(max(value), 3) + 0e0 AS max,
       ROUND(median(value), 3) + 0e0 AS median
FROM ({_stack_sql('shifted', _STAT_COLS, 'side')}) l GROUP BY side, "column" """,
    extra_ctes=f"shifted AS ({shifted_production_sql('trials')})"))
def column_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + D5: mean, sample std, min, max, exact median per side and column (round 3)."""
    s = column_stats(shifted_production(trials(spark, sf_dir)), _STAT_COLS, places=None, by="side")
    return s.withColumns({c: rnd(c, 3) for c in ["mean", "std", "min", "max", "median"]})


@register("stats_compare", with_trials(f"""
SELECT r."column", ROUND(r.m, 6) + 0e0 AS ref_mean, ROUND(c.m, 6) + 0e0 AS cur_mean,
       ROUND(c.m - r.m, 6) + 0e0 AS mean_change
FROM (SELECT "column", avg(value) AS m FROM ({_stack_sql("(SELECT * FROM shifted WHERE side = 'reference')", _STAT_COLS)}) a GROUP BY 1) r
JOIN (SELECT "column", avg(value) AS m FROM ({_stack_sql("(SELECT * FROM shifted WHERE side = 'production')", _STAT_COLS)}) b GROUP BY 1) c
USING ("column") """, extra_ctes=f"shifted AS ({shifted_production_sql('trials')})"))
def stats_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference mean beside production mean."""
    t = shifted_production(trials(spark, sf_dir))
    c = compare_stats(t.filter(F.col("side") == "reference"), t.filter(F.col("side") == "production"),
                      _STAT_COLS)
    return c.select("column", r6("ref_mean").alias("ref_mean"), r6("cur_mean").alias("cur_mean"),
                    r6("mean_change").alias("mean_change"))


@register("value_counts_label", with_trials("""
SELECT side, efficacy_label, CAST(count(*) AS BIGINT) AS count FROM trials GROUP BY side, efficacy_label"""))
def value_counts_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 + A3: label distribution per side."""
    return value_counts(trials(spark, sf_dir), ["side", "efficacy_label"])


@register("event_counts", """
SELECT event_type, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY event_type""")
def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 + L1: event distribution, most frequent first."""
    return value_counts(read_table(spark, sf_dir, "events"), "event_type")
