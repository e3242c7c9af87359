"""Column expressions (P4-P6, P15, P22-P24).  All JVM-side, no UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def number(col: Column | str) -> Column:
    """The column as double with NaN as null (pandas keeps missing numbers as NaN)."""
    c = _c(col).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def is_null(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    c = F.col(name)
    floating = df.schema[name].dataType.typeName() in ("double", "float")
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def clip(col: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound values; null stays null (least/greatest would skip it)."""
    c = _c(col)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNotNull(), out)


def shift_column(col: Column | str, factor: float, lo: float | None = None,
                 hi: float | None = None) -> Column:
    """P5: multiply then clip (makes a shifted production side)."""
    return clip(_c(col) * F.lit(float(factor)), lo, hi)


def rule_flag(pred: Column) -> Column:
    """Boolean rule -> 0/1 int; a null input gives 0 like a pandas NaN compare."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def bucket_case(col: Column | str, rules: Sequence[tuple[str, float, float]],
                default: float) -> Column:
    """First matching (op, bound, value) rule wins, else ``default``.

    ``op`` is one of ``<``, ``<=``, ``>``, ``>=``.  A null input matches no
    rule, a NaN neither (pandas compares NaN as False), and both get ``default``.
    """
    c = number(col)
    ops = {"<": c.__lt__, "<=": c.__le__, ">": c.__gt__, ">=": c.__ge__}
    expr = None
    for op, bound, value in rules:
        cond = F.coalesce(ops[op](F.lit(bound)), F.lit(False))
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def round_n(col: Column | str, n: int = 4) -> Column:
    """Round to n places, HALF_EVEN like Python's ``round``."""
    return F.bround(_c(col), n)


# Confidence bands on max(p, 1 - p).
HIGH_CONFIDENCE = 0.80
MEDIUM_CONFIDENCE = 0.60


def confidence_band(p: Column | str) -> Column:
    """High / medium / low on the unrounded class-1 probability."""
    c = _c(p)
    m = F.greatest(c, F.lit(1.0) - c)
    return (F.when(m >= HIGH_CONFIDENCE, F.lit("high"))
             .when(m >= MEDIUM_CONFIDENCE, F.lit("medium"))
             .otherwise(F.lit("low")))


def default_id(id_col: Column | str, basis: Column, prefix: str = "INFER_") -> Column:
    """Missing id -> deterministic ``INFER_<md5>`` (stable under retries).

    ``basis`` is a string column (hashed as is) or a struct of the row
    (hashed as its JSON text).
    """
    text = basis if not isinstance(basis, Column) else basis
    return F.coalesce(_c(id_col), F.concat(F.lit(prefix), F.md5(text.cast("string"))))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den with 0 when den is 0 (sklearn's zero_division=0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)
