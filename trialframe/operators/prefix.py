"""Ordered running totals that do not funnel into one task.

A plain ``Window.orderBy(v)`` (no partition) or ``partitionBy(column)`` with a
dozen columns runs in one / a dozen tasks.  Here each key's rows are cut into
ranges at approximate quantiles of the order value, so ranges hold about equally many
rows whatever the values' distribution (an outlier does not stretch them).  The range of
a row is a pure function of its value and the key's cuts.  Sums run inside each
(key, range) window, and each range adds the total of all earlier ranges of its key.
The table of range totals has at most ``buckets`` rows per key.

Callers first aggregate to distinct order values, so a value that holds a
third of all rows is one row here.  These rows are read three times (cuts, range totals, windows), so they are
written once to the shared folder instead of being computed three times.  The cuts, a row a key, are counted and
broadcast: a few keys hold all the rows, and joined by key each would be one task's.  A null key is a key like any other; a null
order value has no place in the order and its row is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trialframe.session import materialised, small_table

BUCKETS = 256            # ranges per key


def _with_range(df: DataFrame, order: str, keys: list[str], buckets: int) -> DataFrame:
    """``_key`` (a struct of the keys, never null) and the range number ``_b`` of each row."""
    n = 1 << (buckets - 1).bit_length()      # a power of two: the range is found by halving
    r = df.where(F.col(order).isNotNull()).withColumn("_key", F.struct(*keys) if keys else F.lit(0))
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    cuts = r.groupBy("_key").agg(F.percentile_approx(F.col(order).cast("double"), shares, 20 * n).alias("_cuts"))
    r = r.join(small_table(cuts, "range-cuts"), "_key").withColumn("_b", F.lit(0))
    v, step = F.col(order).cast("double"), n // 2
    while step:          # binary search: the number of cuts below the value
        r = r.withColumn("_b", F.col("_b") + F.when(F.get("_cuts", F.col("_b") + (step - 1)) < v, step).otherwise(0))
        step //= 2
    return r.drop("_cuts")


def running_totals(df: DataFrame, order: str, sums: list[str], keys: list[str] | None = None,
                   buckets: int = BUCKETS, next_value: bool = False, overall: bool = False, stored: bool = False) -> DataFrame:
    """Add ``cum_<c>``: sum of ``c`` over rows of the same keys with order <= this row.

    ``next_value`` adds ``next_<order>``, the next larger order value of the same keys; ``overall`` adds
    ``all_<c>``, the sum over all rows of the same keys, from the range totals.  ``stored`` says that ``df`` is
    read from files, so it is not written again.
    Ties in ``order`` must already be aggregated (one row per key/value).
    """
    keys = list(keys or [])
    r = _with_range(df if stored else materialised(df, "running-totals"), order, keys, buckets)
    inside = Window.partitionBy("_key", "_b").orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = r.groupBy("_key", "_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums], F.min(order).alias("_first"))
    along = Window.partitionBy("_key").orderBy("_b")             # one row a range
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_key", "_b", F.lead("_first").over(along).alias("_next_first"), *[
        F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums], *[
        F.sum(f"_t_{c}").over(Window.partitionBy("_key")).alias(f"all_{c}") for c in sums if overall])
    r = r.withColumns({f"_in_{c}": F.sum(c).over(upto) for c in sums})
    if next_value:
        r = r.withColumn("_lead", F.lead(order).over(inside))
    out = r.join(offsets, ["_key", "_b"])
    out = out.withColumns({f"cum_{c}": F.col(f"_o_{c}") + F.col(f"_in_{c}") for c in sums})
    if next_value:
        out = out.withColumn(f"next_{order}", F.coalesce("_lead", "_next_first")).drop("_lead")
    return out.drop("_key", "_b", "_next_first", *[f"_in_{c}" for c in sums], *[f"_o_{c}" for c in sums])


def with_next_value(df: DataFrame, order: str, keys: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Add ``next_<order>``: the next larger order value within the same keys."""
    return running_totals(df, order, [], keys, buckets, next_value=True)
