"""Column presence and the per-row input contract.

The serving contract is a rule table.  Instead of rejecting a request, a
row that breaks a rule keeps flowing with the list of its violations, so a
batch or a stream splits into good rows and a quarantine with reasons in
one narrow (shuffle-free) projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialframe.functions.columns import is_null


class MissingColumnsError(ValueError):
    pass


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Names in ``required`` that the DataFrame lacks (in required order)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Raise naming every missing column; else return the frame unchanged."""
    miss = missing_columns(df, required)
    if miss:
        raise MissingColumnsError(f"missing columns: {miss}")
    return df


def select_available(df: DataFrame, wanted: list[str]) -> tuple[DataFrame, list[str]]:
    """Keep the wanted columns that exist (in wanted order); report the rest."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have]), [c for c in wanted if c not in have]


def drop_if_exists(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns, ignoring absent names."""
    return df.drop(*cols)


def column_report(df: DataFrame, wanted: list[str]) -> DataFrame:
    """P1/P2/U2 as a table: (ord, column, present, nulls) for each wanted name; an absent column
    is missing in every row.  One pass over the present columns."""
    missing = set(missing_columns(df, wanted))
    counts = F.array(*[F.struct(
        F.lit(i).alias("ord"), F.lit(c).alias("column"), F.lit(c not in missing).alias("present"),
        (F.count(F.lit(1)) if c in missing else F.count_if(is_null(df, c))).cast("long").alias("nulls"))
        for i, c in enumerate(wanted)])
    return df.agg(counts.alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


@dataclass(frozen=True)
class Field:
    name: str
    required: bool
    default: float | None = None
    lo: float | None = None
    hi: float | None = None


# The scoring input contract (required, default, inclusive bounds).
SERVING_CONTRACT = [
    Field("mol_weight", True, None, 50, 1000),
    Field("logp", True, None, -5, 10),
    Field("tpsa", True, None, 0, 300),
    Field("hbd", True, None, 0, 20),
    Field("hba", True, None, 0, 20),
    Field("rotatable_bonds", False, 3, 0, 30),
    Field("aromatic_rings", False, 2, 0, 10),
    Field("patient_age", True, None, 18, 100),
    Field("patient_weight_kg", True, None, 30, 200),
    Field("creatinine_clearance", False, 90, 10, 200),
    Field("is_male", False, 1, 0, 1),
    Field("baseline_crp", False, 5, 0, 200),
    Field("baseline_il6", False, 10, 0, 500),
    Field("baseline_tnfa", False, 15, 0, 500),
    Field("baseline_wbc", False, 7, 0, 50),
    Field("dose_mg", True, None, None, None),
    Field("treatment_days", True, None, 1, 365),
]


def fill_defaults(df: DataFrame, contract: list[Field] = SERVING_CONTRACT) -> DataFrame:
    """P20: defaults for optional inputs (absent column or null value)."""
    cols = {}
    for f in contract:
        if f.default is None:
            continue
        src = F.col(f.name) if f.name in df.columns else F.lit(None).cast("double")
        cols[f.name] = F.coalesce(src.cast("double"), F.lit(float(f.default)))
    return df.withColumns(cols)


def _fmt(x: float | None) -> str:
    return "" if x is None else (f"{int(x)}" if float(x).is_integer() else f"{x}")


def violations(df: DataFrame, contract: list[Field] = SERVING_CONTRACT) -> DataFrame:
    """Add ``violations ARRAY<STRING>`` (empty when the row is valid)."""
    reasons = []
    for f in contract:
        c = F.col(f.name) if f.name in df.columns else F.lit(None).cast("double")
        if f.required:
            reasons.append(F.when(c.isNull(), F.lit(f"{f.name}: required")))
        if f.lo is not None or f.hi is not None:
            bad = F.lit(False)
            if f.lo is not None:
                bad = bad | (c < f.lo)
            if f.hi is not None:
                bad = bad | (c > f.hi)
            if f.lo is not None or f.hi is not None:
                bad = bad | F.isnan(c)
            reasons.append(F.when(c.isNotNull() & bad,
                                  F.lit(f"{f.name}: out of range [{_fmt(f.lo)}, {_fmt(f.hi)}]")))
    return df.withColumn("violations", F.array_compact(F.array(*reasons)))


def validate_contract(df: DataFrame, contract: list[Field] = SERVING_CONTRACT) -> DataFrame:
    """P20 + P21: defaults, then rule violations and an ``is_valid`` flag."""
    out = violations(fill_defaults(df, contract), contract)
    return out.withColumn("is_valid", F.size("violations") == 0)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and the quarantine (both from the same lazy plan)."""
    return checked.filter("is_valid"), checked.filter(~F.col("is_valid"))
