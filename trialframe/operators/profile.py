"""Column profiles.

``column_stats`` computes mean, sample std, min and max of many columns in
one wide aggregate, and the exact median through the bracketed quantile plan.
NaN counts as null everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialframe.functions.columns import is_null, number
from trialframe.operators.quantiles import wide_medians


def column_stats(df: DataFrame, cols: list[str], places: int | None = 3,
                 by: str | None = None) -> DataFrame:
    """(column, mean, std, min, max, median); std is the sample std (ddof 1).

    ``by`` adds a grouping column (for example a side), giving one row per
    (by, column).  ``places`` rounds half to even.  A column without values has no row.
    """
    keys = ([by] if by else []) + ["column"]
    basics = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    stats, medians = wide_medians(df, cols, by=by, more={k: [f(number(c)) for c in cols] for k, f in basics.items()})
    m = medians.select(*[F.col(k).alias(f"_m_{k}") for k in keys], F.col("quantile").alias("median"))
    out = stats.join(m, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys])
    if places is not None:
        out = out.withColumns({c: F.bround(F.col(c), places) + F.lit(0.0) for c in [*basics, "median"]})
    return out.select(*keys, *basics, "median")


def value_counts(df: DataFrame, col: str | list[str]) -> DataFrame:
    """(value, count) most frequent first; ties by value."""
    cols = [col] if isinstance(col, str) else list(col)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).cast("long").alias("count"))
              .orderBy(F.desc("count"), *cols))


def compare_stats(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """Reference mean beside current mean for columns present on both sides."""
    both = [c for c in cols if c in ref.columns and c in cur.columns]

    def means(df: DataFrame, name: str) -> DataFrame:
        one = df.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.avg(number(c)).alias(name)) for c in both]).alias("m"))
        return one.select(F.explode("m").alias("r")).select("r.*")

    r, c = means(ref, "ref_mean"), means(cur, "cur_mean")
    return r.join(c, "column").withColumn("mean_change", F.col("cur_mean") - F.col("ref_mean"))


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A1 + A2: (column, nulls, null_share) per column plus a total row ``*``."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(is_null(df, c)).cast("long").alias(f"_nulls_{i}")
                   for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_nulls_{i}").alias("nulls"))
                     for i, c in enumerate(cols)])
    per = agg.select("_n", F.explode(rows).alias("r")).select("_n", "r.*")
    per = per.withColumn("null_share", F.try_divide(F.col("nulls").cast("double"), F.col("_n")))
    total = per.groupBy().agg(F.lit("*").alias("column"), F.sum("nulls").cast("long").alias("nulls"),
                              F.avg("null_share").alias("null_share"))
    return per.drop("_n").unionByName(total)
