"""Feature recipe (P7, P9-P17) shared by training and scoring.

The recipe is an ordered list of (name, column builder).  It is applied as
one ``withColumns`` projection per dependency level, so the whole recipe
stays inside a single whole-stage-codegen span next to the scan.

The inflammation score divides by a *scale*: either the batch maxima of the
three biomarkers (training form) or fixed constants (serving form).  The
batch maxima come from one aggregate that is joined back as a one-row
broadcast, never from a global window (which would pull all rows into one
task).  A fitted scale can be saved with the model and reused for scoring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialframe.functions.columns import bucket_case, clip, rule_flag
from trialframe.session import small_table

# Inflammation divisors of the serving form and the weights.
FIXED_SCALE = {"baseline_crp": 80.0, "baseline_il6": 200.0, "baseline_tnfa": 300.0}
INFLAMMATION_WEIGHTS = {"baseline_crp": 0.4, "baseline_il6": 0.35, "baseline_tnfa": 0.25}
LOG_COLUMNS = ["baseline_crp", "baseline_il6", "baseline_tnfa"]
AGE_RULES = [("<", 30.0, 1.2), (">", 65.0, 0.7)]
AGE_DEFAULT = 1.0

# The 29 model inputs in order (17 raw + 12 derived).
FEATURE_COLS = [
    "mol_weight", "logp", "tpsa", "hbd", "hba", "rotatable_bonds", "aromatic_rings",
    "patient_age", "patient_weight_kg", "creatinine_clearance", "is_male",
    "baseline_crp", "baseline_il6", "baseline_tnfa", "baseline_wbc",
    "dose_mg", "treatment_days",
    "ro5_violations", "is_drug_like", "bioavailability_score", "inflammation_score",
    "renal_adjusted_dose", "bsa_proxy", "dose_per_bsa", "treatment_intensity",
    "age_metabolism_factor", "log_baseline_crp", "log_baseline_il6", "log_baseline_tnfa",
]

DERIVED_COLS = [
    "ro5_mw_ok", "ro5_logp_ok", "ro5_hbd_ok", "ro5_hba_ok", "ro5_violations", "is_drug_like",
    "bioavailability_score", "inflammation_score", "renal_adjusted_dose", "bsa_proxy",
    "dose_per_bsa", "treatment_intensity", "age_metabolism_factor",
    "log_baseline_crp", "log_baseline_il6", "log_baseline_tnfa",
]


def rule_of_five(df: DataFrame) -> DataFrame:
    """Four Lipinski flags, violation count and drug-likeness."""
    c = F.col
    flags = {
        "ro5_mw_ok": rule_flag(c("mol_weight") <= 500),
        "ro5_logp_ok": rule_flag(c("logp") <= 5),
        "ro5_hbd_ok": rule_flag(c("hbd") <= 5),
        "ro5_hba_ok": rule_flag(c("hba") <= 10),
    }
    df = df.withColumns(flags)
    df = df.withColumn("ro5_violations", F.lit(4) - (c("ro5_mw_ok") + c("ro5_logp_ok")
                                                    + c("ro5_hbd_ok") + c("ro5_hba_ok")))
    return df.withColumn("is_drug_like", rule_flag(c("ro5_violations") <= 1))


def bioavailability_score() -> Column:
    """Weighted terms of violations, polar surface and flexibility, clipped 0..1."""
    c = F.col
    return clip((F.lit(1.0) - c("ro5_violations") / F.lit(4.0)) * F.lit(0.5)
                + rule_flag(c("tpsa") < 140).cast("double") * F.lit(0.3)
                + rule_flag(c("rotatable_bonds") < 10).cast("double") * F.lit(0.2), 0.0, 1.0)


def inflammation_score(scale: dict[str, Column | float]) -> Column:
    """Biomarkers over their scale, weighted, clipped 0..1.

    A zero divisor gives null (``try_divide``) instead of an ANSI error.
    """
    terms = None
    for col, w in INFLAMMATION_WEIGHTS.items():
        den = scale[col] if isinstance(scale[col], Column) else F.lit(float(scale[col]))
        t = F.try_divide(F.col(col), den) * F.lit(w)
        terms = t if terms is None else terms + t
    return clip(terms, 0.0, 1.0)


def fit_scale(df: DataFrame, by: str | None = None) -> DataFrame:
    """The batch maxima of the three biomarkers (one row, or one per ``by`` group)."""
    g = df.groupBy(by) if by else df.groupBy()
    return g.agg(*[F.max(c).cast("double").alias(f"scale_{c}") for c in FIXED_SCALE])


def engineer_features(df: DataFrame, scale: str | dict[str, float] | DataFrame = "batch",
                      drop_timestamp: bool = True, by: str | None = None) -> DataFrame:
    """All derived columns in one projection.

    ``scale``: ``"batch"`` (maxima of this DataFrame, the training form),
    ``"fixed"`` (serving constants), a dict of divisors, or a one-row
    DataFrame from :func:`fit_scale` (a saved fitted scale).  With ``by``,
    batch maxima are taken per group (e.g. per side, as each side is its
    own batch); the group table is written, counted and broadcast if small, as
    a few groups joined by key would go to as few tasks.
    """
    c = F.col
    scale_df = None
    if isinstance(scale, str) and scale == "batch":
        scale_df = fit_scale(df, by)
    elif isinstance(scale, DataFrame) and by is not None and by in scale.columns:
        scale_df = scale
    elif isinstance(scale, DataFrame):
        rows = scale.limit(2).collect()
        if len(rows) != 1:
            raise ValueError("a fitted scale has exactly one row")
        scale = {k: rows[0][f"scale_{k}"] for k in FIXED_SCALE}
    if scale_df is not None:
        if by is not None and by in scale_df.columns:
            df = df.join(small_table(scale_df, "scale"), by)
        else:
            # one-row aggregate: a broadcast of a provably single row
            df = df.crossJoin(F.broadcast(scale_df))
        divisors = {k: c(f"scale_{k}") for k in FIXED_SCALE}
    elif isinstance(scale, dict):
        divisors = {k: float(scale[k]) for k in FIXED_SCALE}
    else:
        divisors = dict(FIXED_SCALE)
    df = rule_of_five(df)
    df = df.withColumns({
        "bioavailability_score": bioavailability_score(),
        "inflammation_score": inflammation_score(divisors),
        "renal_adjusted_dose": clip(c("dose_mg") * (c("creatinine_clearance") / F.lit(90.0)), 0.0, 800.0),
        "bsa_proxy": F.sqrt(c("patient_weight_kg") / F.lit(70.0)),
        "treatment_intensity": c("dose_mg") * c("treatment_days") / F.lit(1000.0),
        "age_metabolism_factor": bucket_case("patient_age", AGE_RULES, AGE_DEFAULT),
        **{f"log_{k}": F.log1p(c(k)) for k in LOG_COLUMNS},
    })
    df = df.withColumn("dose_per_bsa", c("dose_mg") / c("bsa_proxy"))
    drop = [f"scale_{k}" for k in FIXED_SCALE] if scale_df is not None else []
    if drop_timestamp:
        drop.append("ingestion_timestamp")
    return df.drop(*drop)
