"""Imputation.

``fill_median`` computes exact medians for all requested columns in one
stacked plan (see :mod:`trialframe.operators.quantiles`) and applies them
with ``coalesce`` against a one-row broadcast (one row per input column:
the size is bounded by the column count, not the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialframe.functions.columns import number
from trialframe.operators.quantiles import exact_medians


def median_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with a ``median_<col>`` column per input column."""
    long = exact_medians(df, cols)
    return long.groupBy().pivot("column", cols).agg(F.first("median")).select(
        *[F.col(c).alias(f"median_{c}") for c in cols])


def fill_median(df: DataFrame, cols: list[str], medians: DataFrame | None = None) -> DataFrame:
    """Nulls -> column median (exact, like pandas ``median``).

    ``medians`` may be a saved one-row table from :func:`median_table`
    (the fitted imputer), so scoring uses training medians.
    """
    if medians is not None:
        rows = medians.limit(2).collect()
        if len(rows) != 1:
            raise ValueError("a saved median table has exactly one row")
        return df.withColumns({c: F.coalesce(number(c), F.lit(rows[0][f"median_{c}"])) for c in cols})
    out = df.crossJoin(F.broadcast(median_table(df, cols)))        # one row: an aggregate without keys
    out = out.withColumns({c: F.coalesce(number(c), F.col(f"median_{c}")) for c in cols})
    return out.drop(*[f"median_{c}" for c in cols])


def fill_constant(df: DataFrame, cols: list[str] | None = None, value: float = 0.0) -> DataFrame:
    """Nulls (and NaN) -> a constant."""
    cols = cols or [f.name for f in df.schema.fields
                    if f.dataType.typeName() in ("double", "float", "integer", "long")]
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def filled(c):
        if types[c] in ("double", "float"):
            return F.coalesce(F.nanvl(F.col(c), F.lit(None).cast(types[c])), F.lit(float(value)))
        return F.coalesce(F.col(c), F.lit(value).cast(types[c]))
    return df.withColumns({c: filled(c) for c in cols})
