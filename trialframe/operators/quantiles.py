"""Exact quantiles that scale (used by P18 median fill and A8 column stats).

Spark's exact ``percentile`` keeps every distinct value of a group in one
final buffer, which does not hold at 100 TB.  Instead:

1. one wide aggregate: row count and an approximate bracket ``[lo, hi]`` around the
   target ranks of every column (``percentile_approx``, rank error below n/ACCURACY);
2. second pass: the values are counted, those below ``lo`` or above ``hi`` together
   and those inside the bracket by distinct value, so a hot value is one row;
3. running counts over the bracket's distinct values give the exact order
   statistics; the quantile interpolates like pandas.

Nulls and NaN are ignored.  If a bracket misses its ranks (it cannot within the
sketch's guarantee) the query fails rather than return a wrong value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialframe.functions.columns import number
from trialframe.operators.prefix import running_totals
from trialframe.session import materialised

ACCURACY = 10_000


def stack_long(df: DataFrame, cols: list[str], value: str = "value",
               keep: list[str] | None = None) -> DataFrame:
    """Wide -> long: (column, value) rows, nulls and NaN dropped."""
    keep = keep or []
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), number(c).alias(value)) for c in cols])
    return (df.select(*keep, F.explode(pairs).alias("kv"))
              .select(*keep, "kv.column", f"kv.{value}")
              .filter(F.col(value).isNotNull()))


def bracket(v: Column, q: float, accuracy: int = ACCURACY) -> Column:
    """Aggregate: array [lo, hi] around the quantile's ranks."""
    eps = 3.0 / accuracy
    return F.percentile_approx(v, F.array(F.lit(max(0.0, q - eps)), F.lit(min(1.0, q + eps))), accuracy)


def _from_counts(counts: DataFrame, bounds: DataFrame, q: float, keys: list[str]) -> DataFrame:
    """(keys, n, quantile) from ``bounds`` (keys, n) and ``counts`` (keys, zone, value, c, top, bottom):
    zone 0 holds the bracket's distinct values, -1 and 1 what lies below and above it in one row each.

    A rank can lie one order statistic outside the bracket; that is the zone's ``top`` or ``bottom``.
    """
    named = lambda zone, p, *cols: counts.where(F.col("zone") == zone).select(      # noqa: E731
        *[F.col(k).alias(f"{p}{k}") for k in keys], *cols)
    same = lambda p: [F.col(k).eqNullSafe(F.col(f"{p}{k}")) for k in keys]          # noqa: E731
    below = named(-1, "_b_", F.col("c").alias("_below"), F.col("top").alias("_under"))
    above = named(1, "_a_", F.col("bottom").alias("_over"))
    inside = running_totals(counts.where("zone = 0").select(*keys, "value", "c"), "value", ["c"], keys=keys)
    pos = F.lit(q) * (F.col("n") - 1)
    start = F.coalesce("_below", F.lit(0))
    upto = start + F.col("cum_c")
    sizes = bounds.select(*[F.col(k).alias(f"_n_{k}") for k in keys], "n")
    rows = inside.join(sizes, same("_n_")).join(below, same("_b_"), "left").join(above, same("_a_"), "left")
    at = lambda rank: F.coalesce(F.min(F.when((rank >= start) & (upto > rank), F.col("value"))),             # noqa: E731
                                 F.max(F.when(rank == start - 1, F.col("_under"))),
                                 F.min(F.when(rank == F.col("_all"), F.col("_over"))))
    last = rows.groupBy(*[F.col(k).alias(f"_l_{k}") for k in keys]).agg(F.max(upto).alias("_all"))
    rows = rows.join(last, same("_l_"))
    out = rows.groupBy(*keys, "n").agg(at(F.floor(pos)).alias("_first"), at(F.ceil(pos)).alias("_second"))
    value = F.col("_first") + (F.col("_second") - F.col("_first")) * (pos - F.floor(pos))
    return out.select(*keys, "n", F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.lit("the quantile's bracket missed its ranks")).cast("double")).alias("quantile"))


def _zone(v: Column, lo: Column, hi: Column) -> Column:
    return F.when(v < lo, -1).when(v > hi, 1).otherwise(0)


def _counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``counts`` for ``_from_counts`` from rows (keys, zone, v)."""
    return (rows.groupBy(*keys, "zone", F.when(F.col("zone") == 0, F.col("v")).alias("value"))
            .agg(F.count(F.lit(1)).alias("c"), F.max("v").alias("top"), F.min("v").alias("bottom")))


def exact_quantile_long(long: DataFrame, q: float = 0.5, key: str = "column",
                        value: str = "value", accuracy: int = ACCURACY) -> DataFrame:
    """Exact linear-interpolated quantile per ``key`` of a long table: (key, n, quantile)."""
    rows = long.select(key, number(value).alias("v")).where("v is not null")
    bounds = rows.groupBy(key).agg(F.count("v").alias("n"), bracket(F.col("v"), q, accuracy).alias("_range"))
    b = bounds.select(F.col(key).alias("_k"), F.col("_range")[0].alias("_lo"), F.col("_range")[1].alias("_hi"))
    beside = rows.join(b, F.col(key).eqNullSafe(F.col("_k")))
    counts = _counted(beside.select(key, "v", _zone(F.col("v"), F.col("_lo"), F.col("_hi")).alias("zone")), [key])
    return _from_counts(counts, bounds, q, [key])


def wide_medians(df: DataFrame, cols: list[str], by: str | None = None,
                 more: dict[str, list[Column]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Exact medians of many columns without stacking the table: what lies outside the brackets is counted by a second
    wide aggregate, and only the values inside them, about six in ``ACCURACY``, become rows.

    Returns (by, column, n, ``more``...) from one wide aggregate, and (by, column, n, quantile).
    ``more`` maps a statistic's name to one aggregate per column.
    """
    keys, more = [by] if by else [], more or {}
    aggregates = [F.struct(F.lit(c).alias("column"), F.count(number(c)).alias("n"), bracket(number(c), 0.5).alias("_range"),
                           *[exprs[i].alias(name) for name, exprs in more.items()]) for i, c in enumerate(cols)]
    one = df.groupBy(*keys).agg(F.array(*aggregates).alias("_stats"))         # one row, or one per value of ``by``
    one = materialised(one, "quantile-brackets")
    stats = one.select(*keys, F.explode("_stats").alias("s")).select(*keys, "s.*")
    ends_of = lambda i, k: F.col("_stats")[i]["_range"][k]      # noqa: E731
    ranges = one.select(*[F.col(k).alias(f"_o_{k}") for k in keys],
                        *[ends_of(i, k).alias(f"_r{k}_{i}") for i in range(len(cols)) for k in (0, 1)])
    on = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    values = df.select(*keys, *[number(c).alias(f"_v_{i}") for i, c in enumerate(cols)])
    beside = values.join(ranges, on) if keys else values.crossJoin(ranges)
    v = lambda i: F.col(f"_v_{i}")                      # noqa: E731
    below = lambda i: v(i) < F.col(f"_r0_{i}")          # noqa: E731
    above = lambda i: v(i) > F.col(f"_r1_{i}")          # noqa: E731
    outside = beside.groupBy(*keys).agg(F.array(*[F.struct(
        F.lit(c).alias("column"), F.count_if(below(i)).alias("c"), F.max(F.when(below(i), v(i))).alias("top"),
        F.min(F.when(above(i), v(i))).alias("bottom")) for i, c in enumerate(cols)]).alias("o"))
    outside = outside.select(*keys, F.explode("o").alias("o")).select(*keys, "o.*")
    zones = F.explode(F.array(F.struct(F.lit(-1).alias("zone"), F.col("c"), F.col("top"), F.lit(None).cast("double").alias("bottom")),
                              F.struct(F.lit(1).alias("zone"), F.lit(0).cast("long").alias("c"), F.lit(None).cast("double").alias("top"), F.col("bottom"))))
    ends = outside.select(*keys, "column", zones.alias("z")).select(*keys, "column", "z.zone", F.lit(None).cast("double").alias("value"),
                                                                    "z.c", "z.top", "z.bottom")
    entries = F.array(*[F.when(~below(i) & ~above(i), F.struct(F.lit(c).alias("column"), v(i).alias("v"))) for i, c in enumerate(cols)])
    inside = beside.select(*keys, F.explode(F.array_compact(entries)).alias("e")).select(*keys, "e.*", F.lit(0).alias("zone"))
    counts = materialised(_counted(inside, [*keys, "column"]).unionByName(ends), "quantile-counts")
    quantiles = _from_counts(counts, stats.where("n > 0"), 0.5, [*keys, "column"])
    return stats.drop("_range"), quantiles


def exact_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n, median) for each column with values, nulls and NaN ignored."""
    return wide_medians(df, cols)[1].withColumnRenamed("quantile", "median")
