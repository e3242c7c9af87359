"""Prefix sums, exact quantiles, AUC, KS and windowed KS against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialframe.operators.drift import ks_pvalue, ks_statistics, second_test, windowed_ks
from trialframe.operators.evaluate import classification_metrics, roc_auc
from trialframe.operators.prefix import running_totals, with_next_value
from trialframe.operators.profile import column_stats
from trialframe.operators.quantiles import exact_medians
from trialframe.operators.split import stratified_folds, stratified_split


def test_running_totals_with_hot_value(spark):
    rnd = random.Random(1)
    vals = [rnd.uniform(0, 100) for _ in range(3000)] + [42.0] * 1500   # a third at one value
    rows = [(k, v) for k in ("a", "b") for v in vals]
    df = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"))
    out = running_totals(df, "v", ["c"], keys=["k"], buckets=7).collect()
    for k in ("a", "b"):
        got = sorted((r.v, r.cum_c) for r in out if r.k == k)
        xs = np.array(sorted(vals))
        for v, c in got[::97]:
            assert c == int(np.searchsorted(xs, v, side="right"))


def test_next_value(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 9, 3, 7]], "v double")
    got = sorted((r.v, r.next_v) for r in with_next_value(df, "v", buckets=3).collect())
    assert got == [(1.0, 3.0), (3.0, 5.0), (5.0, 7.0), (7.0, 9.0), (9.0, None)]


def test_column_stats_fixture(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 5.0), (3.0, 6.0)], "a double, b double")
    r = {x.column: x for x in column_stats(df, ["a", "b"]).collect()}
    assert (r["a"].mean, r["a"].std, r["a"].median) == (2.0, 1.0, 2.0)
    assert (r["b"].mean, r["b"].std, r["b"].median) == (5.0, 1.0, 5.0)


def test_exact_median_even_and_nulls(spark):
    rnd = random.Random(3)
    xs = [rnd.gauss(0, 1) for _ in range(4000)]
    df = spark.createDataFrame([(x, None if i % 3 == 0 else x) for i, x in enumerate(xs)], "a double, b double")
    r = {x.column: x.median for x in exact_medians(df, ["a", "b"]).collect()}
    assert r["a"] == pytest.approx(float(np.median(xs)), abs=1e-12)
    assert r["b"] == pytest.approx(float(np.median([x for i, x in enumerate(xs) if i % 3])), abs=1e-12)


def _auc_brute(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rnd = random.Random(5)
    y = [rnd.randint(0, 1) for _ in range(600)]
    s = [round(rnd.random(), 1) for _ in range(600)]   # many ties
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    got = roc_auc(df, "y", "s", buckets=5).first().roc_auc
    assert got == pytest.approx(_auc_brute(y, s), abs=1e-12)


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    m = classification_metrics(df, "y", "p").first()
    assert (m.precision, m.recall, m.f1_score, m.accuracy) == (0.0, 0.0, 0.0, 1.0)


def _ks_brute(a, b):
    xs = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), xs, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), xs, side="right") / len(b)
    return float(np.max(np.abs(fa - fb)))


def test_ks_statistic_and_pvalue(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, 500), rng.normal(0.3, 1, 300)
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    r = ks_statistics(ref, cur, ["x"], places=None, buckets=4).first()
    assert r.ks_statistic == pytest.approx(_ks_brute(a, b), abs=1e-12)
    lam = r.ks_statistic * math.sqrt(500 * 300 / 800)
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert r.p_value == pytest.approx(series, abs=1e-9)
    assert r.drifted


def test_pvalue_known_point(spark):
    # lambda = 1.3581 -> p = 0.05
    df = spark.createDataFrame([(1.3581, 1_000_000, 1_000_000)], "d double, n1 long, n2 long")
    lam_d = F.col("d") / F.sqrt(F.col("n1").cast("double") * F.col("n2") / (F.col("n1") + F.col("n2")))
    p = df.select(ks_pvalue(lam_d, F.col("n1"), F.col("n2"))).first()[0]
    assert p == pytest.approx(0.05, abs=1e-4)


def test_same_law_not_drifted_shift_drifted(spark):
    rng = np.random.default_rng(7)
    ref = spark.createDataFrame([(float(x), float(y)) for x, y in zip(rng.normal(50, 10, 500), rng.integers(0, 3, 500))],
                                "age double, dose double")
    same = spark.createDataFrame([(float(x), float(y)) for x, y in zip(rng.normal(50, 10, 200), rng.integers(0, 3, 200))],
                                 "age double, dose double")
    shifted = same.withColumn("age", F.col("age") * 1.5)
    r_same = {x.column: x.drifted for x in ks_statistics(ref, same, ["age", "dose"]).collect()}
    r_shift = {x.column: x.drifted for x in ks_statistics(ref, shifted, ["age", "dose"]).collect()}
    assert not r_same["age"] and r_shift["age"]
    tests = {x.column: x.test for x in second_test(ref, shifted, ["age", "dose"], categorical=["dose"]).collect()}
    assert tests == {"age": "wasserstein_norm", "dose": "chi_square"}


def test_windowed_ks_matches_per_window(spark):
    rng = np.random.default_rng(11)
    ref = rng.normal(0, 1, 400)
    wins = {w: rng.normal(0.1 * w, 1, 150 + 10 * w) for w in range(4)}
    rdf = spark.createDataFrame([(float(x),) for x in ref], "v double")
    cdf = spark.createDataFrame([(w, float(x)) for w, xs in wins.items() for x in xs], "w int, v double")
    got = {r.w: r.ks_statistic for r in windowed_ks(rdf, cdf, "v", "w", places=None, buckets=3).collect()}
    for w, xs in wins.items():
        assert got[w] == pytest.approx(_ks_brute(ref, xs), abs=1e-12)


def test_split_and_folds_are_exact_per_stratum(spark):
    rows = [(f"id{i}", 1 if i % 3 == 0 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id string, y int")
    s = stratified_split(df, "id", "y", 0.2, 42)
    c = {(r.y, r.is_test): r["count"] for r in s.groupBy("y", "is_test").count().collect()}
    assert c[(1, True)] == math.ceil(0.2 * 334) and c[(0, True)] == math.ceil(0.2 * 666)
    f = stratified_folds(df, "id", "y", 5, 42)
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sizes[-1] - sizes[0] <= 2
