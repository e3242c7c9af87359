"""Queries: trials view, column operators, feature recipe, contract, imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.functions.columns import clip, default_id, shift_column
from trialframe.functions.recipe import DERIVED_COLS, FEATURE_COLS, FIXED_SCALE, engineer_features
from trialframe.operators.contract import column_report, validate_contract
from trialframe.operators.impute import fill_constant, fill_median
from trialframe.plans.catalog import r6, register, round_doubles
from trialframe.plans.fixtures import NULL_RULES, with_faults, with_faults_sql, with_nulls, with_nulls_sql
from trialframe.plans.oracle import with_trials
from trialframe.sources.tables import RAW_COLUMNS, label_score, lipinski_ok, trials


def features_sql(src: str, scale: str = "fixed", by: str | None = None) -> str:
    """The recipe as SQL.  ``scale``: fixed divisors, or batch maxima (per ``by``)."""
    if scale == "fixed":
        den = {k: f"{v!r}e0".replace(".0e0", "e0") for k, v in FIXED_SCALE.items()}
        join, src2 = "", src
    else:
        den = {k: f"sc.m_{k}" for k in FIXED_SCALE}
        grp = f" GROUP BY {by}" if by else ""
        sel = f"{by}, " if by else ""
        on = f" USING ({by})" if by else " ON TRUE"
        maxes = ", ".join(f"max({k}) AS m_{k}" for k in FIXED_SCALE)
        src2 = f"(SELECT s.*, {', '.join(f'sc.m_{k}' for k in FIXED_SCALE)} FROM {src} s JOIN (SELECT {sel}{maxes} FROM {src}{grp}) sc{on})"
        den = {k: f"m_{k}" for k in FIXED_SCALE}
    return f"""
    SELECT f2.* EXCLUDE ({', '.join(f'm_{k}' for k in FIXED_SCALE) if scale != 'fixed' else 'ingestion_timestamp'}),
           dose_mg / bsa_proxy AS dose_per_bsa
    FROM (
      SELECT f1.*,
        LEAST(GREATEST((1e0 - ro5_violations / 4e0) * 0.5e0
              + CAST(COALESCE(tpsa < 140, false) AS DOUBLE) * 0.3e0
              + CAST(COALESCE(rotatable_bonds < 10, false) AS DOUBLE) * 0.2e0, 0e0), 1e0) AS bioavailability_score,
        LEAST(GREATEST(baseline_crp / {den['baseline_crp']} * 0.4e0
              + baseline_il6 / {den['baseline_il6']} * 0.35e0
              + baseline_tnfa / {den['baseline_tnfa']} * 0.25e0, 0e0), 1e0) AS inflammation_score,
        LEAST(GREATEST(dose_mg * (creatinine_clearance / 90e0), 0e0), 800e0) AS renal_adjusted_dose,
        sqrt(patient_weight_kg / 70e0) AS bsa_proxy,
        dose_mg * treatment_days / 1000e0 AS treatment_intensity,
        CASE WHEN patient_age < 30 THEN 1.2e0 WHEN patient_age > 65 THEN 0.7e0 ELSE 1.0e0 END AS age_metabolism_factor,
        ln(1e0 + baseline_crp) AS log_baseline_crp,
        ln(1e0 + baseline_il6) AS log_baseline_il6,
        ln(1e0 + baseline_tnfa) AS log_baseline_tnfa
      FROM (
        SELECT r.*, 4 - (ro5_mw_ok + ro5_logp_ok + ro5_hbd_ok + ro5_hba_ok) AS ro5_violations,
               CAST(4 - (ro5_mw_ok + ro5_logp_ok + ro5_hbd_ok + ro5_hba_ok) <= 1 AS INTEGER) AS is_drug_like
        FROM (
          SELECT s.*,
            CAST(COALESCE(mol_weight <= 500, false) AS INTEGER) AS ro5_mw_ok,
            CAST(COALESCE(logp <= 5, false) AS INTEGER) AS ro5_logp_ok,
            CAST(COALESCE(hbd <= 5, false) AS INTEGER) AS ro5_hbd_ok,
            CAST(COALESCE(hba <= 10, false) AS INTEGER) AS ro5_hba_ok
          FROM {src2} s
        ) r
      ) f1
    ) f2"""


def _features(spark: SparkSession, sf_dir: str, scale: str) -> DataFrame:
    t = trials(spark, sf_dir)
    f = engineer_features(t, scale=scale, by="side" if scale == "batch" else None)
    return round_doubles(f.select("row_key", "side", *DERIVED_COLS))


_FEAT_OUT = ", ".join(f"ROUND({c}, 6) + 0e0 AS {c}" if c not in (
    "ro5_mw_ok", "ro5_logp_ok", "ro5_hbd_ok", "ro5_hba_ok", "ro5_violations", "is_drug_like") else c
    for c in DERIVED_COLS)


@register("batch_profile", with_trials(f"""
SELECT batch_id, CAST(count(*) AS BIGINT) AS n_rows,
       ROUND(avg(CAST(is_drug_like AS DOUBLE)), 6) + 0e0 AS drug_like_share,
       ROUND(avg(inflammation_score), 6) + 0e0 AS mean_inflammation,
       ROUND(avg(CAST(efficacy_label AS DOUBLE)), 6) + 0e0 AS efficacy_rate
FROM ({features_sql('trials', 'batch')}) f GROUP BY batch_id"""))
def batch_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: trials -> features (batch scale) -> per batch drug-likeness,
    inflammation and efficacy."""
    f = engineer_features(trials(spark, sf_dir), scale="batch")
    return f.groupBy("batch_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        r6(F.avg(F.col("is_drug_like").cast("double"))).alias("drug_like_share"),
        r6(F.avg("inflammation_score")).alias("mean_inflammation"),
        r6(F.avg(F.col("efficacy_label").cast("double"))).alias("efficacy_rate"))


_TRIAL_OUT = ["row_key", *RAW_COLUMNS, "noise", "side"]


@register("trials_view", with_trials("SELECT " + ", ".join(
    f"ROUND({c}, 6) + 0e0 AS {c}" if c in (
        "mol_weight", "logp", "tpsa", "patient_weight_kg", "creatinine_clearance", "baseline_crp",
        "baseline_il6", "baseline_tnfa", "baseline_wbc", "noise") else c
    for c in _TRIAL_OUT) + " FROM trials"))
def trials_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(trials(spark, sf_dir).select(*_TRIAL_OUT))


@register("clip_shift", with_trials("""
SELECT row_key, side,
  ROUND(CASE WHEN side = 'production' THEN LEAST(GREATEST(patient_age * 1.1e0, 18e0), 80e0) ELSE patient_age END, 6) + 0e0 AS patient_age,
  ROUND(CASE WHEN side = 'production' THEN LEAST(GREATEST(baseline_crp * 1.4e0, 0e0), 80e0) ELSE baseline_crp END, 6) + 0e0 AS baseline_crp,
  ROUND(LEAST(GREATEST(tpsa, 30e0), 150e0), 6) + 0e0 AS tpsa_clipped
FROM trials"""))
def clip_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + P5: shifted production side and a plain clip."""
    t = trials(spark, sf_dir)
    prod = F.col("side") == "production"
    return t.select(
        "row_key", "side",
        r6(F.when(prod, shift_column("patient_age", 1.1, 18, 80)).otherwise(F.col("patient_age"))).alias("patient_age"),
        r6(F.when(prod, shift_column("baseline_crp", 1.4, 0, 80)).otherwise(F.col("baseline_crp"))).alias("baseline_crp"),
        r6(clip("tpsa", 30, 150)).alias("tpsa_clipped"))


@register("rule_of_five", with_trials(f"""
SELECT row_key, ro5_mw_ok, ro5_logp_ok, ro5_hbd_ok, ro5_hba_ok, ro5_violations, is_drug_like
FROM ({features_sql('trials', 'fixed')}) f"""))
def rule_of_five_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 + P7."""
    from trialframe.functions.recipe import rule_of_five
    return rule_of_five(trials(spark, sf_dir)).select(
        "row_key", "ro5_mw_ok", "ro5_logp_ok", "ro5_hbd_ok", "ro5_hba_ok", "ro5_violations", "is_drug_like")


@register("label_from_score", with_trials("""
SELECT row_key,
  ROUND(0.30e0 * CAST((mol_weight <= 500 AND logp <= 5 AND hbd <= 5 AND hba <= 10) AS DOUBLE)
        + 0.15e0 * (dose_mg / 400e0) + 0.10e0 * (treatment_days / 90e0)
        + 0.10e0 * (1e0 - baseline_crp / 80e0) + 0.10e0 * (creatinine_clearance / 150e0)
        + 0.25e0 * noise, 6) + 0e0 AS score,
  efficacy_label
FROM trials"""))
def label_from_score_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted score and its 0/1 label."""
    t = trials(spark, sf_dir)
    s = label_score(lipinski_ok(F.col("mol_weight"), F.col("logp"), F.col("hbd"), F.col("hba")),
                    F.col("dose_mg"), F.col("treatment_days"), F.col("baseline_crp"),
                    F.col("creatinine_clearance"), F.col("noise"))
    return t.select("row_key", r6(s).alias("score"), "efficacy_label")


@register("feature_recipe_batch", with_trials(
    f"SELECT row_key, side, {_FEAT_OUT} FROM ({features_sql('trials', 'batch', by='side')}) f"))
def feature_recipe_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9-P17, training form: inflammation divided by each side's own maxima."""
    return _features(spark, sf_dir, "batch")


@register("feature_recipe_fixed", with_trials(
    f"SELECT row_key, side, {_FEAT_OUT} FROM ({features_sql('trials', 'fixed')}) f"))
def feature_recipe_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 + P17, serving form: fixed divisors."""
    return _features(spark, sf_dir, "fixed")


@register("scale_skew", with_trials(f"""
SELECT b.side, CAST(count(*) AS BIGINT) AS n_rows,
  ROUND(avg(abs(b.inflammation_score - x.inflammation_score)), 6) + 0e0 AS mean_abs_diff,
  ROUND(max(abs(b.inflammation_score - x.inflammation_score)), 6) + 0e0 AS max_abs_diff
FROM ({features_sql('trials', 'batch', by='side')}) b
JOIN ({features_sql('trials', 'fixed')}) x USING (row_key)
GROUP BY b.side"""))
def scale_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 vs P11: how far the batch-scaled score is from the serving score.

    Both forms are computed in one projection over one scan (no self-join).
    """
    t = trials(spark, sf_dir)
    b = engineer_features(t, scale="batch", by="side").withColumnRenamed("inflammation_score", "s_batch")
    from trialframe.functions.recipe import inflammation_score
    b = b.withColumn("s_fixed", inflammation_score(FIXED_SCALE))
    diff = F.abs(F.col("s_batch") - F.col("s_fixed"))
    return b.groupBy("side").agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                                 r6(F.avg(diff)).alias("mean_abs_diff"), r6(F.max(diff)).alias("max_abs_diff"))


@register("require_columns_report", with_trials(" UNION ALL ".join(
    f"SELECT {i} AS ord, '{c}' AS \"column\", true AS present, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM trials"
    if c in RAW_COLUMNS else f"SELECT {i}, '{c}', false, CAST(count(*) AS BIGINT) FROM trials"
    for i, c in enumerate(FEATURE_COLS)) + " "))
def require_columns_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2 + U2: which model inputs the raw table has, and how many rows lack them."""
    return column_report(trials(spark, sf_dir).select(*RAW_COLUMNS), FEATURE_COLS)


_CONTRACT_COLS = ["mol_weight", "logp", "tpsa", "hbd", "hba", "rotatable_bonds", "aromatic_rings",
                  "patient_age", "patient_weight_kg", "creatinine_clearance", "is_male",
                  "baseline_crp", "baseline_il6", "baseline_tnfa", "baseline_wbc", "dose_mg",
                  "treatment_days"]


def _violations_sql() -> tuple[str, str]:
    """The defaults as a REPLACE list, and the list of a row's violations."""
    from trialframe.operators.contract import SERVING_CONTRACT, _fmt
    filled = ", ".join(f"COALESCE({f.name}, {float(f.default)!r}e0) AS {f.name}".replace(".0e0", "e0")
                       for f in SERVING_CONTRACT if f.default is not None)
    reasons = []
    for f in SERVING_CONTRACT:
        if f.required:
            reasons.append(f"CASE WHEN {f.name} IS NULL THEN '{f.name}: required' END")
        if f.lo is not None or f.hi is not None:
            conds = []
            if f.lo is not None:
                conds.append(f"{f.name} < {f.lo}")
            if f.hi is not None:
                conds.append(f"{f.name} > {f.hi}")
            conds.append(f"isnan({f.name})")
            reasons.append(f"CASE WHEN {f.name} IS NOT NULL AND ({' OR '.join(conds)}) "
                           f"THEN '{f.name}: out of range [{_fmt(f.lo)}, {_fmt(f.hi)}]' END")
    return filled, "list_filter([" + ", ".join(reasons) + "], lambda x: x IS NOT NULL)"


def scored_violations_sql() -> str:
    """Production rows by their violations (over the relation ``shifted``)."""
    filled, arr = _violations_sql()
    return f"""
    SELECT violations, violations <> '' AS refused, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT array_to_string({arr}, '; ') AS violations
          FROM (SELECT * REPLACE ({filled}) FROM shifted WHERE side = 'production') a) b GROUP BY 1, 2"""


def _contract_sql() -> str:
    filled, arr = _violations_sql()
    return with_trials(f"""
    SELECT row_key,
      COALESCE(sample_id, 'INFER_' || md5(row_key)) AS sample_id,
      len(v) = 0 AS is_valid,
      array_to_string(v, '; ') AS violations
    FROM (SELECT *, {arr} AS v FROM (SELECT * REPLACE ({filled}) FROM faulted) a) b""",
                       extra_ctes=f"faulted AS ({with_faults_sql('trials')})")


@register("contract_quarantine", _contract_sql())
def contract_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20 + P21 + P23: defaults, per-row violations (quarantine reasons), ids."""
    t = with_faults(trials(spark, sf_dir))
    v = validate_contract(t)
    return v.select("row_key", default_id("sample_id", F.col("row_key")).alias("sample_id"),
                    "is_valid", F.array_join("violations", "; ").alias("violations"))


_NULL_COLS = list(NULL_RULES)


@register("impute_median", with_trials(
    "SELECT row_key, " + ", ".join(
        f"ROUND(COALESCE({c}, (SELECT median({c}) FROM nulled)), 6) + 0e0 AS {c}" for c in _NULL_COLS)
    + " FROM nulled", extra_ctes=f"nulled AS ({with_nulls_sql('trials')})"))
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact median fill of the nulled columns."""
    t = with_nulls(trials(spark, sf_dir))
    return round_doubles(fill_median(t, _NULL_COLS).select("row_key", *_NULL_COLS))


@register("impute_constant", with_trials(
    "SELECT row_key, " + ", ".join(f"ROUND(COALESCE({c}, 0e0), 6) + 0e0 AS {c}" for c in _NULL_COLS)
    + " FROM nulled", extra_ctes=f"nulled AS ({with_nulls_sql('trials')})"))
def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero fill."""
    t = with_nulls(trials(spark, sf_dir))
    return round_doubles(fill_constant(t, _NULL_COLS, 0.0).select("row_key", *_NULL_COLS))
