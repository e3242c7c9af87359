"""Data-quality suite.

A suite is a list of :class:`Check`.  ``run_suite`` turns the whole list
into ONE aggregate over the table (scan shared by all checks), plus one
grouping-sets pass for the duplicate and value-list checks.  The one-row result is exploded into a (check, status, observed,
details) table; nothing is collected except by the gate, which reads the
one-row summary.

Row rules count failing rows with ``count_if(NOT coalesce(rule, false))``:
a null or NaN fails the rule (pandas compares NaN as False) and an empty table
passes (pandas ``all()`` of nothing is True).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialframe.functions.columns import is_null, number
from trialframe.sources.tables import DOSES


@dataclass(frozen=True)
class Check:
    name: str
    kind: str            # not_null | null_rate | range | isin | mean_between | unique | min_rows | rule
    column: str | None = None
    args: dict = field(default_factory=dict)


# The 15 checks of the trial suite, in order, with their bounds.
TRIAL_CHECKS = [
    Check("no_null_sample_ids", "not_null", "sample_id"),
    Check("overall_null_rate_below_5pct", "null_rate", None, {"below": 0.05}),
    Check("mol_weight_range", "range", "mol_weight", {"lo": 50, "hi": 1000, "fmt": "%.1f"}),
    Check("logp_range", "range", "logp", {"lo": -5, "hi": 10, "fmt": "%.2f"}),
    Check("patient_age_range", "range", "patient_age", {"lo": 0, "hi": 120, "fmt": "%.0f"}),
    Check("dose_mg_valid_values", "isin", "dose_mg", {"values": DOSES}),
    Check("efficacy_label_binary", "isin", "efficacy_label", {"values": [0, 1]}),
    Check("label_balance_not_extreme", "mean_between", "efficacy_label", {"lo": 0.15, "hi": 0.85}),
    Check("no_duplicate_sample_ids", "unique", "sample_id"),
    Check("minimum_sample_size", "min_rows", None, {"n": 100}),
    Check("baseline_crp_non_negative", "rule", "baseline_crp", {"op": ">=", "bound": 0}),
    Check("baseline_il6_non_negative", "rule", "baseline_il6", {"op": ">=", "bound": 0}),
    Check("baseline_tnfa_non_negative", "rule", "baseline_tnfa", {"op": ">=", "bound": 0}),
    Check("baseline_wbc_non_negative", "rule", "baseline_wbc", {"op": ">=", "bound": 0}),
    Check("treatment_days_positive", "rule", "treatment_days", {"op": ">", "bound": 0, "fmt": "%.0f"}),
]

MAX_FAILED_CHECKS = 3     # gate: stop when more than this many checks fail


class QualityGateError(RuntimeError):
    pass


def _fails(pred: Column) -> Column:
    return F.count_if(~F.coalesce(pred, F.lit(False))).cast("long")


def _rule(c: Column, op: str, bound: float) -> Column:
    return {">=": c >= bound, ">": c > bound, "<=": c <= bound, "<": c < bound}[op]


def null_counts(df: DataFrame, cols: list[str] | None = None) -> list[Column]:
    """A1: one null count (NaN included) per column (to be used in one agg)."""
    cols = cols or df.columns
    return [F.count_if(is_null(df, c)).cast("long").alias(f"nulls__{c}") for c in cols]


def total_nulls(df: DataFrame, cols: list[str]) -> Column:
    """A1 total, A2 numerator; null counts summed inside the same aggregate."""
    return sum((F.count_if(is_null(df, c)).cast("long") for c in cols), F.lit(0).cast("long"))


def null_rate(df: DataFrame, cols: list[str] | None = None) -> Column:
    """A2: mean over columns of the null share = total nulls / (rows x columns)."""
    cols = cols or df.columns
    return F.try_divide(total_nulls(df, cols).cast("double"), F.count(F.lit(1)) * F.lit(len(cols)))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """A4: rows after the first per key (nulls are one group, as in pandas).

    Shuffles on the key once, with map-side partial counts, so a hot key
    collapses before the exchange.
    """
    return (df.groupBy(key).count()
              .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates")))


def check_values(df: DataFrame, checks: list[Check] | None = None) -> DataFrame:
    """A5: (check, value, n) - every distinct value that an isin check met, as rows, without a limit."""
    isin = [c for c in (TRIAL_CHECKS if checks is None else checks) if c.kind == "isin"]
    pairs = F.array(*[F.struct(F.lit(c.name).alias("check"), F.col(c.column).cast("string").alias("value")) for c in isin])
    return (df.select(F.explode(pairs).alias("p")).groupBy("p.check", "p.value")
            .agg(F.count(F.lit(1)).cast("long").alias("n")))


def known(df: DataFrame, name: str) -> Column:
    """The column, NaN as null."""
    return F.when(~is_null(df, name), F.col(name))


def _observed_and_details(df: DataFrame, chk: Check):
    """Aggregate expressions for one check: (observed, passed, details)."""
    a = chk.args
    if chk.kind == "not_null":
        n = F.count_if(is_null(df, chk.column)).cast("long")
        return n.cast("double"), n == 0, F.format_string("nulls=%d", n)
    if chk.kind == "null_rate":
        r = null_rate(df)
        return r, F.coalesce(r < a["below"], F.lit(False)), F.format_string("null_rate=%.2f%%", r * 100)
    if chk.kind == "range":
        c = known(df, chk.column)
        n = _fails(c.between(a["lo"], a["hi"]))
        fmt = a.get("fmt", "%.1f")
        det = F.format_string(f"range=[{fmt}, {fmt}]", F.min(c), F.max(c))
        return n.cast("double"), n == 0, det
    if chk.kind == "isin":
        n = _fails(F.col(chk.column).isin(list(a["values"])))
        return n.cast("double"), n == 0, None
    if chk.kind == "mean_between":
        m = F.avg(number(chk.column))
        ok = F.coalesce((m > a["lo"]) & (m < a["hi"]), F.lit(False))
        return m, ok, F.format_string("efficacy_rate=%.2f%%", m * 100)
    if chk.kind == "min_rows":
        n = F.count(F.lit(1))
        return n.cast("double"), n >= a["n"], F.format_string("n_samples=%d", n)
    if chk.kind == "rule":
        c = known(df, chk.column)
        n = _fails(_rule(c, a["op"], a["bound"]))
        if a["op"] == ">":
            fmt = a.get("fmt", "%.0f")
            det = F.format_string(f"range=[{fmt}, {fmt}]", F.min(c), F.max(c))
        else:
            det = F.format_string(a.get("fmt", "min=%.3f"), F.min(c))
        return n.cast("double"), n == 0, det
    if chk.kind == "unique":
        return None, None, None          # separate grouped aggregate
    raise ValueError(f"unknown check kind {chk.kind}")


def _grouped_side_checks(df: DataFrame, checks: list[Check]) -> DataFrame | None:
    """Duplicate counts and value lists of all checks from ONE grouping-sets pass.

    ``groupingSets`` expands each row once per grouped column and shuffles the
    partial counts once; one aggregate over them gives every check its part, as a filter for each
    check would be pushed below the exchange and read the table once more.  Returns one row with
    ``dup_<i>`` or ``det_<i>`` for check ``i``.
    """
    cols = sorted({c.column for c in checks if c.kind in ("unique", "isin")})
    if not cols:
        return None
    g = df.groupingSets([[c] for c in cols], *cols).agg(
        F.count(F.lit(1)).cast("long").alias("_n"), F.grouping_id().alias("_gid"))
    gid = {c: (1 << len(cols)) - 1 - (1 << (len(cols) - 1 - i)) for i, c in enumerate(cols)}
    out = []
    for i, chk in enumerate(checks):
        if chk.kind == "unique":
            more = F.sum(F.when(F.col("_gid") == gid[chk.column], F.col("_n") - 1))
            out.append(F.coalesce(more, F.lit(0)).cast("long").alias(f"dup_{i}"))
        elif chk.kind == "isin":
            out.append(F.format_string("distinct_values=%d", F.count_if(F.col("_gid") == gid[chk.column])).alias(f"det_{i}"))
    return g.agg(*out)


def run_suite(df: DataFrame, checks: list[Check] = TRIAL_CHECKS) -> DataFrame:
    """Every check from one shared scan plus one grouping-sets pass.

    Returns (ord, check, status, observed, details); ``observed`` is the
    measured number (failing rows, rate, mean, row count or duplicates).
    """
    exprs, rows = [], []
    side = _grouped_side_checks(df, checks)
    for i, chk in enumerate(checks):
        obs, ok, det = _observed_and_details(df, chk)
        if chk.kind == "unique":
            obs, ok = F.col(f"dup_{i}").cast("double"), F.col(f"dup_{i}") == 0
            det = F.format_string("duplicates=%d", F.col(f"dup_{i}"))
            rows.append((i, chk.name, obs, ok, det))
            continue
        exprs += [obs.alias(f"obs_{i}"), ok.alias(f"ok_{i}")]
        if det is not None:
            exprs.append(det.alias(f"det_{i}"))
        rows.append((i, chk.name, F.col(f"obs_{i}"), F.col(f"ok_{i}"), F.col(f"det_{i}")))
    one = df.agg(*exprs)
    if side is not None:      # a provably one-row aggregate
        one = one.crossJoin(F.broadcast(side))
    table = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(name).alias("check"),
                 F.when(F.coalesce(ok, F.lit(False)), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
                 obs.cast("double").alias("observed"), det.alias("details"))
        for i, name, obs, ok, det in rows])
    return one.select(F.explode(table).alias("r")).select("r.*")


def suite_summary(results: DataFrame) -> DataFrame:
    """Total, passed, failed, pass_rate (one row)."""
    return results.agg(
        F.count(F.lit(1)).cast("long").alias("total_checks"),
        F.count_if(F.col("status") == "PASS").cast("long").alias("passed"),
        F.count_if(F.col("status") == "FAIL").cast("long").alias("failed"),
    ).withColumn("pass_rate", F.try_divide(F.col("passed").cast("double"), F.col("total_checks")))


def failed_checks(results: DataFrame) -> DataFrame:
    """P25: the failing checks only."""
    return results.filter(F.col("status") == "FAIL")


def gate(results: DataFrame, max_failed: int = MAX_FAILED_CHECKS) -> dict:
    """G1: read the one-row summary; raise when more than ``max_failed`` fail."""
    s = suite_summary(results).first().asDict()
    if s["failed"] > max_failed:
        raise QualityGateError(f"{s['failed']} checks failed (limit {max_failed})")
    return s
