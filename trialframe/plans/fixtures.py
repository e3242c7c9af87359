"""Deterministic fault and null fixtures over the trials view.

Rules are fixed functions of ``noise`` (itself a function of l_partkey), so
Spark and SQL pick the same rows, and the fixture grows with the data.
Each has an SQL twin used by the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialframe.functions.columns import shift_column

# Which rows are nulled / faulted (ranges of noise).
NULL_RULES = {
    "baseline_crp": (0.00, 0.03),
    "patient_weight_kg": (0.97, 1.00),
    "tpsa": (0.50, 0.52),
}


def _in(lo: float, hi: float):
    return (F.col("noise") >= lo) & (F.col("noise") < hi)


def with_nulls(t: DataFrame) -> DataFrame:
    """Null a few measures by rule (for imputation and null profiles)."""
    return t.withColumns({c: F.when(~_in(lo, hi), F.col(c)) for c, (lo, hi) in NULL_RULES.items()})


def with_nulls_sql(src: str = "trials") -> str:
    sets = ", ".join(f"CASE WHEN NOT (noise >= {lo!r}e0 AND noise < {hi!r}e0) THEN {c} END AS {c}"
                     .replace("e0e0", "e0") for c, (lo, hi) in NULL_RULES.items())
    return f"SELECT * REPLACE ({sets}) FROM {src}"


def with_faults(t: DataFrame) -> DataFrame:
    """Rows that break the scoring contract, by rule: missing id, a missing
    required dose, out-of-range weight and age, a missing optional biomarker."""
    return t.withColumns({
        "sample_id": F.when(~_in(0.99, 1.0), F.col("sample_id")),
        "mol_weight": F.when(_in(0.10, 0.15), F.col("mol_weight") * 1.5).otherwise(F.col("mol_weight")),
        "patient_age": F.when(_in(0.20, 0.25), F.col("patient_age") + 30.0).otherwise(F.col("patient_age")),
        "dose_mg": F.when(~_in(0.30, 0.31), F.col("dose_mg")),
        "baseline_il6": F.when(~_in(0.40, 0.45), F.col("baseline_il6")),
    })


def with_faults_sql(src: str = "trials") -> str:
    return f"""SELECT * REPLACE (
      CASE WHEN NOT (noise >= 0.99e0 AND noise < 1.0e0) THEN sample_id END AS sample_id,
      CASE WHEN noise >= 0.10e0 AND noise < 0.15e0 THEN mol_weight * 1.5e0 ELSE mol_weight END AS mol_weight,
      CASE WHEN noise >= 0.20e0 AND noise < 0.25e0 THEN patient_age + 30e0 ELSE patient_age END AS patient_age,
      CASE WHEN NOT (noise >= 0.30e0 AND noise < 0.31e0) THEN dose_mg END AS dose_mg,
      CASE WHEN NOT (noise >= 0.40e0 AND noise < 0.45e0) THEN baseline_il6 END AS baseline_il6
    ) FROM {src}"""


# The production shift (age x1.1 clipped 18..80, crp x1.4 clipped 0..80).
SHIFTS = {"patient_age": (1.1, 18.0, 80.0), "baseline_crp": (1.4, 0.0, 80.0)}


def shifted_production(t: DataFrame) -> DataFrame:
    """P5 applied to the production side only."""
    prod = F.col("side") == "production"
    return t.withColumns({c: F.when(prod, shift_column(c, f, lo, hi)).otherwise(F.col(c))
                          for c, (f, lo, hi) in SHIFTS.items()})


def shifted_production_sql(src: str = "trials") -> str:
    sets = ", ".join(
        f"CASE WHEN side = 'production' THEN LEAST(GREATEST({c} * {f!r}e0, {lo!r}e0), {hi!r}e0) "
        f"ELSE {c} END AS {c}".replace("e0e0", "e0")
        for c, (f, lo, hi) in SHIFTS.items())
    return f"SELECT * REPLACE ({sets}) FROM {src}"
