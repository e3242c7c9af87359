"""Two-sample drift tests between a reference and arriving data.

KS statistic (D1): stack both sides to (column, value, side), aggregate to
distinct values with per-side counts, bucketed running counts per column,
``max |F_ref - F_cur|``.  One job for all monitored columns.

KS p-value (D2): up to ``EXACT_MAX`` values a side the exact law by counting lattice paths (``ks_exact``, one
small computation a tested column); beyond it Kolmogorov's limiting distribution as a column expression (two series,
each exact to double precision in its own range; ``ks_asymptotic``).

Second test (D4): goodness-of-fit chi-square against the reference shares
for columns declared categorical, normed Wasserstein-1 for the others.

Windowed drift (D9): the reference CDF is computed once over the distinct
values of reference and all windows together (no copy of the reference per
window), then every window is compared with it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from trialframe.operators.prefix import BUCKETS, running_totals
from trialframe.operators.quantiles import stack_long
from trialframe.session import materialised

# Monitored columns, p-value threshold and drift share gate.
MONITOR_FEATURES = [
    "mol_weight", "logp", "tpsa", "patient_age", "patient_weight_kg",
    "creatinine_clearance", "baseline_crp", "baseline_il6", "dose_mg",
    "treatment_days", "bioavailability_score", "inflammation_score",
]
P_THRESHOLD = 0.05
MAX_DRIFT_SHARE = 0.15
WASSERSTEIN_THRESHOLD = 0.1
# Fixed value: monitored columns that are lists of fixed values, tested by chi-square.
CATEGORICAL = ["dose_mg"]
SERIES_TERMS = 10
# Fixed value: the larger side's size up to which the exact law is used.
EXACT_MAX = 10_000


def ks_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """Two-sided asymptotic p-value Q(lambda), lambda = d*sqrt(n1*n2/(n1+n2)).

    Q = 1 - sqrt(2 pi)/lambda * sum exp(-(2k-1)^2 pi^2 / (8 lambda^2))   (lambda < 1.18)
    Q = 2 * sum (-1)^(k-1) exp(-2 k^2 lambda^2)                          (otherwise)
    """
    lam = d * F.sqrt(n1.cast("double") * n2 / (n1 + n2))
    small = F.lit(0.0)
    large = F.lit(0.0)
    for k in range(1, SERIES_TERMS + 1):
        small = small + F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0) / (lam * lam))
        large = large + F.lit(float((-1) ** (k - 1))) * F.exp(F.lit(-2.0 * k * k) * lam * lam)
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * small
    large = F.lit(2.0) * large
    q = F.when(lam <= 0, F.lit(1.0)).when(lam < 1.18, small).otherwise(large)
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))


def exact_ks_tail(d: float, n1: int, n2: int) -> float:
    """P(D >= d) for samples of ``n1`` and ``n2`` values without ties.

    An order of the n1 + n2 values is a lattice path from (0, 0) to (n1, n2); D < d if the path stays where
    |i / n1 - j / n2| < d.  Such paths are counted row by row: within a row's allowed columns the counts are running
    sums of the row before.  Rows are rescaled by powers of two, so counts stay within doubles.
    """
    n1, n2 = max(n1, n2), min(n1, n2)
    step = math.gcd(n1, n2)
    a, b = n1 // step, n2 // step
    reach = round(d * a * n2)               # d is a whole multiple of 1 / lcm(n1, n2)
    if reach <= 0:
        return 1.0
    low, scale = 0, 0
    row = np.ones(min(n2, (reach - 1) // a) + 1)             # i = 0: j * a < reach
    for i in range(1, n1 + 1):
        lo, hi = max(0, -((reach - 1 - i * b) // a)), min(n2, (reach - 1 + i * b) // a)      # |i b - j a| < reach
        if lo > hi:
            return 1.0
        above = np.zeros(hi - lo + 1)
        first, last = max(lo, low), min(hi, low + len(row) - 1)
        if first <= last:
            above[first - lo:last - lo + 1] = row[first - low:last - low + 1]
        row, low = np.cumsum(above), lo
        top = math.frexp(row[-1])[1] if row[-1] else 0
        if top > 500:
            row, scale = np.ldexp(row, -top), scale + top
    if not row[-1]:
        return 1.0
    log_all = math.lgamma(n1 + n2 + 1) - math.lgamma(n1 + 1) - math.lgamma(n2 + 1)
    inside = math.exp(math.log(row[-1]) + scale * math.log(2.0) - log_all)
    return min(max(1.0 - inside, 0.0), 1.0)


@F.pandas_udf(DoubleType())
def exact_ks_pvalue(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    """D2 for small samples: one number a tested column."""
    return pd.Series([None if pd.isna(x) else exact_ks_tail(float(x), int(a), int(b)) for x, a, b in zip(d, n1, n2, strict=True)],
                     dtype="float64")


def ks_pvalue_sql(d: str, n1: str, n2: str) -> str:
    """The same p-value as SQL text (for the DuckDB oracle)."""
    lam = f"({d} * sqrt(CAST({n1} AS DOUBLE) * {n2} / ({n1} + {n2})))"
    small = " + ".join(f"exp({-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0!r} / ({lam} * {lam}))"
                       for k in range(1, SERIES_TERMS + 1))
    large = " + ".join(f"{float((-1) ** (k - 1))!r} * exp({-2.0 * k * k!r} * {lam} * {lam})"
                       for k in range(1, SERIES_TERMS + 1))
    q = (f"CASE WHEN {lam} <= 0 THEN 1e0 WHEN {lam} < 1.18 THEN "
         f"1e0 - {math.sqrt(2 * math.pi)!r} / {lam} * ({small}) ELSE 2e0 * ({large}) END")
    return f"LEAST(GREATEST({q}, 0e0), 1e0)"


def _sides(ref: DataFrame, cur: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """(keys, column, value, is_ref) rows of both sides, nulls dropped."""
    r = stack_long(ref, cols, keep=keys).withColumn("is_ref", F.lit(1))
    c = stack_long(cur, cols, keep=keys).withColumn("is_ref", F.lit(0))
    return r.unionByName(c)


def value_counts_by_side(ref: DataFrame, cur: DataFrame | None, cols: list[str],
                         side: Column | None = None) -> DataFrame:
    """(column, value, n_ref, n_cur): distinct values with per-side counts.

    Either two DataFrames, or one DataFrame (``ref``) and a boolean ``side``
    expression that is true on reference rows: then the table is scanned and
    stacked once.
    """
    if cur is None:
        long = stack_long(ref.withColumn("is_ref", side.cast("int")), cols, keep=["is_ref"])
    else:
        long = _sides(ref, cur, cols, [])
    return long.groupBy("column", "value").agg(
        F.sum("is_ref").cast("long").alias("n_ref"),
        F.sum(F.lit(1) - F.col("is_ref")).cast("long").alias("n_cur"))


def _round(c: Column, places: int | None) -> Column:
    return c if places is None else F.bround(c, places)


def ks_statistics(ref: DataFrame, cur: DataFrame | None, cols: list[str] = MONITOR_FEATURES,
                  buckets: int = BUCKETS, places: int | None = 4,
                  side: Column | None = None, exact: bool = False) -> DataFrame:
    """D1 + D2: (ord, column, ks_statistic, p_value, drifted, n_ref, n_cur, method); ``exact`` takes the exact law
    for columns of up to ``EXACT_MAX`` values a side, else the limiting law is used at every size.

    Columns absent on either side are skipped; a side with < 2 values gives
    null statistic and ``drifted = false``.  Statistic and p-value are
    rounded to 4; ``drifted`` uses the unrounded p.
    """
    cols = [c for c in cols if c in ref.columns and (cur is None or c in cur.columns)]
    return ks_from_counts(value_counts_by_side(ref, cur, cols, side), cols, buckets, places, exact)


def ks_from_counts(counts: DataFrame, cols: list[str], buckets: int = BUCKETS, places: int | None = 4,
                   exact: bool = False) -> DataFrame:
    """D1 + D2 from (column, value, n_ref, n_cur); see :func:`ks_statistics`."""
    g = running_totals(counts, "value", ["n_ref", "n_cur"], keys=["column"], buckets=buckets, overall=True)
    g = g.withColumnsRenamed({"all_n_ref": "tot_ref", "all_n_cur": "tot_cur"})
    diff = F.abs(F.col("cum_n_ref") / F.col("tot_ref") - F.col("cum_n_cur") / F.col("tot_cur"))
    d = g.groupBy("column", "tot_ref", "tot_cur").agg(F.max(diff).alias("d"))
    order = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    ok = (F.col("tot_ref") > 1) & (F.col("tot_cur") > 1)
    small, p = F.lit(False), ks_pvalue(F.col("d"), F.col("tot_ref"), F.col("tot_cur"))
    if exact:
        small = ok & (F.greatest("tot_ref", "tot_cur") <= EXACT_MAX)
        d = d.withColumn("exact_p", exact_ks_pvalue(F.when(small, F.col("d")), "tot_ref", "tot_cur"))
        p = F.when(small, F.col("exact_p")).otherwise(p)
    out = d.select(
        order[F.col("column")].alias("ord"), "column",
        F.when(ok, _round(F.col("d"), places)).alias("ks_statistic"),
        F.when(ok, _round(p, places)).alias("p_value"),
        F.coalesce(ok & (p < P_THRESHOLD), F.lit(False)).alias("drifted"),
        F.col("tot_ref").alias("n_ref"), F.col("tot_cur").alias("n_cur"),
        F.when(small, F.lit("ks_exact")).when(ok, F.lit("ks_asymptotic")).alias("method"))
    # a column with no values at all on a side still gets a row
    allc = counts.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)], "ord int, column string")
    return allc.join(out.drop("ord"), "column", "left").select(
        "ord", "column", "ks_statistic", "p_value",
        F.coalesce("drifted", F.lit(False)).alias("drifted"),
        F.coalesce("n_ref", F.lit(0)).cast("long").alias("n_ref"),
        F.coalesce("n_cur", F.lit(0)).cast("long").alias("n_cur"), "method")


def drift_summary(per_column: DataFrame, n_reference: Column | int, n_current: Column | int,
                  max_share: float = MAX_DRIFT_SHARE) -> DataFrame:
    """D3 + D6 + D7: one row with the dataset verdict.

    ``alert`` = detected OR share > gate (the monitor's rule);
    ``retrain`` = detected AND share > gate (the trigger's rule).
    """
    pc = per_column
    share = F.try_divide(F.count_if("drifted").cast("double"), F.count(F.lit(1)))
    drifted = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.struct("ord", "column"))))
    s = pc.agg(
        F.count_if("drifted").cast("long").alias("n_drifted_features"),
        F.count(F.lit(1)).cast("long").alias("n_total_features"),
        F.coalesce(share, F.lit(0.0)).alias("_share"),
        F.transform(drifted, lambda x: x["column"]).alias("drifted_columns"),
        (F.array_join(F.array_sort(F.collect_set("method")), ",") if "method" in pc.columns else F.lit("ks_asymptotic")).alias("method"))
    s = s.withColumns({
        "dataset_drift_detected": F.col("n_drifted_features") > 0,
        "share_drifted_features": F.bround("_share", 4),
        "n_reference_samples": F.lit(n_reference) if not isinstance(n_reference, Column) else n_reference,
        "n_current_samples": F.lit(n_current) if not isinstance(n_current, Column) else n_current,
    })
    s = s.withColumns({
        "alert": F.col("dataset_drift_detected") | (F.col("_share") > max_share),
        "retrain": F.col("dataset_drift_detected") & (F.col("_share") > max_share),
    })
    return s.drop("_share")


def chi_square_tail(x: float, df: int) -> float:
    """P(X > x) of the chi-square law with ``df`` degrees of freedom (finite series)."""
    h = x / 2
    if df % 2 == 0:
        return math.exp(-h) * sum(h ** i / math.factorial(i) for i in range(df // 2))
    return math.erfc(math.sqrt(h)) + math.exp(-h) * sum(h ** (i - 0.5) / math.gamma(i + 0.5) for i in range(1, df // 2 + 1))


def chi_square_critical(df: int, p: float = P_THRESHOLD) -> float:
    """The value that the chi-square law with ``df`` degrees of freedom exceeds with probability ``p``."""
    lo, hi = 0.0, df + 20.0 * math.sqrt(2.0 * df) + 20
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_tail(mid, df) > p else (lo, mid)
    return (lo + hi) / 2


def second_test(ref: DataFrame, cur: DataFrame | None, cols: list[str] = MONITOR_FEATURES,
                categorical: list[str] = CATEGORICAL, max_values: int = 100, buckets: int = BUCKETS,
                side: Column | None = None) -> DataFrame:
    """Chi-square goodness of fit for the ``categorical`` columns, normed
    Wasserstein-1 for the others.  The kind is declared, never read off the data.

    Returns (column, test, statistic, threshold, drifted).  Chi-square:
    expected = reference count x n_cur / n_ref, drifted when the statistic
    exceeds the 95 % critical value for (reference values - 1) degrees of freedom, or
    when a value never seen in the reference arrives (the statistic is then infinite: null).
    A categorical column of more than ``max_values`` reference values fails the query.
    Wasserstein: sum |F_ref - F_cur| dx over sorted distinct values divided by
    the reference population std; drifted above 0.1.
    """
    cols = [c for c in cols if c in ref.columns and (cur is None or c in cur.columns)]
    listed = F.col("column").isin([c for c in cols if c in categorical])
    g = materialised(value_counts_by_side(ref, cur, cols, side), "second-test")      # read by the sums and by both tests
    per_col = g.groupBy(F.col("column").alias("_c")).agg(
        F.count_if(F.col("n_ref") > 0).alias("k_ref"),
        F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"),
        F.try_divide(F.sum(F.col("value") * F.col("n_ref")), F.sum("n_ref")).alias("mean_ref"),
        F.try_divide(F.sum(F.col("value") * F.col("value") * F.col("n_ref")), F.sum("n_ref")).alias("m2_ref"))
    per_col = per_col.withColumn(
        "std_ref", F.sqrt(F.greatest(F.col("m2_ref") - F.col("mean_ref") * F.col("mean_ref"), F.lit(0.0))))
    per_col = F.broadcast(per_col)                # one row per column
    # chi-square part
    cg = g.where(listed).join(per_col, F.col("column") == F.col("_c"))
    exp_ = F.col("n_ref") * (F.col("tot_cur").cast("double") / F.col("tot_ref"))
    chi = cg.groupBy("column", "k_ref").agg(
        F.sum(F.when(exp_ > 0, (F.col("n_cur") - exp_) ** 2 / exp_)).alias("_stat"),
        F.count_if((F.col("n_ref") == 0) & (F.col("n_cur") > 0)).alias("_new"))
    chi = chi.withColumn("statistic", F.when(F.col("_new") == 0, F.col("_stat")))
    limits = F.array(*[F.lit(chi_square_critical(k)) for k in range(1, max_values)])
    crit = F.when(F.col("k_ref") <= max_values, F.get(limits, F.greatest(F.col("k_ref") - 2, F.lit(0)).cast("int"))).otherwise(
        F.raise_error(F.format_string("%s has more than %d reference values", F.col("column"), F.lit(max_values))).cast("double"))
    chi = chi.withColumn("threshold", crit).select(
        "column", F.lit("chi_square").alias("test"), "statistic", "threshold",
        ((F.col("_new") > 0) | F.coalesce(F.col("statistic") > F.col("threshold"), F.lit(False))).alias("drifted"))
    # Wasserstein part
    wg = running_totals(g.where(~listed), "value", ["n_ref", "n_cur"], keys=["column"], buckets=buckets, next_value=True,
                        stored=True)
    wg = wg.join(per_col, F.col("column") == F.col("_c"))
    step = F.abs(F.col("cum_n_ref") / F.col("tot_ref") - F.col("cum_n_cur") / F.col("tot_cur")) * (
        F.col("next_value") - F.col("value"))
    w = wg.groupBy("column", "std_ref").agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("w1"))
    w = w.select("column", F.lit("wasserstein_norm").alias("test"),
                 F.try_divide(F.col("w1"), F.col("std_ref")).alias("statistic"),
                 F.lit(WASSERSTEIN_THRESHOLD).alias("threshold"))
    w = w.withColumn("drifted", F.coalesce(F.col("statistic") > WASSERSTEIN_THRESHOLD, F.lit(False)))
    return chi.unionByName(w)


def second_test_summary(per_column: DataFrame, max_share: float = MAX_DRIFT_SHARE) -> DataFrame:
    """D4 for the dataset, from :func:`second_test`: columns tested and drifted, their share, and whether it exceeds the gate (one row)."""
    n, share = F.count(F.lit(1)), F.try_divide(F.count_if("drifted").cast("double"), F.count(F.lit(1)))
    return per_column.agg(n.cast("long").alias("n_columns"), F.count_if("drifted").cast("long").alias("n_drifted"),
                          share.alias("share_drifted"), F.coalesce(share > max_share, F.lit(False)).alias("dataset_drift"))


def windowed_ks(ref: DataFrame, cur: DataFrame, value: str, window: str,
                buckets: int = BUCKETS, places: int | None = 4) -> DataFrame:
    """KS of one reference against every time slice ``window`` of ``cur``.

    Per window w with sorted distinct values x_1 < ... < x_m, the largest gap
    between the step functions is the max over j of
    |F_ref(x_j) - F_w(x_j)| and |F_ref(x_{j+1}-) - F_w(x_j)| (and F_ref(x_1-)).
    F_ref at every point comes from one bucketed prefix sum over the
    distinct values of reference and windows together.
    Returns (window, ks_statistic, p_value, drifted, n_ref, n_cur).
    """
    return windowed_ks_from_counts(value_counts(ref, value, "n_ref"), window_counts(cur, value, window), window, buckets, places)


def value_counts(df: DataFrame, value: str, name: str) -> DataFrame:
    """(v, ``name``): distinct values of one column with their counts."""
    return (df.select(F.col(value).cast("double").alias("v")).where("v is not null")
            .groupBy("v").agg(F.count(F.lit(1)).cast("long").alias(name)))


def window_counts(df: DataFrame, value: str, window: str) -> DataFrame:
    """(w, v, n_cur): distinct values of each time slice with their counts."""
    return (df.select(F.col(window).alias("w"), F.col(value).cast("double").alias("v")).where("v is not null")
            .groupBy("w", "v").agg(F.count(F.lit(1)).cast("long").alias("n_cur")))


def windowed_ks_from_counts(ref_counts: DataFrame, wc: DataFrame, window: str, buckets: int = BUCKETS,
                            places: int | None = 4) -> DataFrame:
    """D9 from the reference's (v, n_ref) and the slices' (w, v, n_cur); see :func:`windowed_ks`."""
    points = wc.select("v").distinct().withColumn("n_ref", F.lit(0).cast("long"))
    allv = ref_counts.unionByName(points).groupBy("v").agg(F.sum("n_ref").alias("n_ref"))
    allv = running_totals(allv, "v", ["n_ref"], buckets=buckets)
    n_ref = ref_counts.agg(F.sum("n_ref").alias("tot_ref"))
    cdf = allv.crossJoin(F.broadcast(n_ref)).select(   # one-row broadcast
        "v", (F.col("cum_n_ref") / F.col("tot_ref")).alias("f_ref"),
        ((F.col("cum_n_ref") - F.col("n_ref")) / F.col("tot_ref")).alias("f_ref_below"), "tot_ref")
    wc = running_totals(wc, "v", ["n_cur"], keys=["w"], buckets=buckets, next_value=True)
    wn = wc.groupBy("w").agg(F.sum("n_cur").alias("tot_cur"), F.min("v").alias("v_first"))
    wc = wc.join(wn, "w").join(cdf, "v")
    nxt = cdf.select(F.col("v").alias("next_v"), F.col("f_ref_below").alias("f_ref_below_next"))
    wc = wc.join(nxt, "next_v", "left")
    f_w = F.col("cum_n_cur") / F.col("tot_cur")
    gap = F.greatest(
        F.abs(F.col("f_ref") - f_w),
        F.coalesce(F.abs(F.col("f_ref_below_next") - f_w), F.lit(0.0)),
        F.when(F.col("v") == F.col("v_first"), F.col("f_ref_below")).otherwise(F.lit(0.0)))
    d = wc.groupBy("w", "tot_ref", "tot_cur").agg(F.max(gap).alias("d"))
    ok = (F.col("tot_ref") > 1) & (F.col("tot_cur") > 1)
    p = ks_pvalue(F.col("d"), F.col("tot_ref"), F.col("tot_cur"))
    return d.select(F.col("w").alias(window),
                    F.when(ok, _round(F.col("d"), places)).alias("ks_statistic"),
                    F.when(ok, _round(p, places)).alias("p_value"),
                    F.coalesce(ok & (p < P_THRESHOLD), F.lit(False)).alias("drifted"),
                    F.col("tot_ref").cast("long").alias("n_ref"), F.col("tot_cur").cast("long").alias("n_cur"))


def drift_history_entry(summary: DataFrame, report_id: str, at: str) -> DataFrame:
    """A drift verdict as a history row."""
    return summary.select(F.lit(report_id).alias("report_id"), F.lit(at).cast("timestamp_ntz").alias("reported_at"), "*")


def append_history(entry: DataFrame, root: str) -> None:
    entry.write.mode("append").parquet(f"{root}/drift_history")


def history_status(history: DataFrame) -> DataFrame:
    """Number of reports and the latest one (one row)."""
    latest = F.max_by(F.struct(*history.columns), F.struct("reported_at", "report_id"))
    return history.agg(F.count(F.lit(1)).cast("long").alias("n_reports"), latest.alias("latest"))


def ranked(per_column: DataFrame) -> DataFrame:
    """K6: columns by KS statistic, largest first (ties by name)."""
    return per_column.orderBy(F.desc_nulls_last("ks_statistic"), "column")
