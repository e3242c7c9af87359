"""Registered queries: one Spark plan per operator family, with its oracle SQL.

Every query reads the driver's tables (or what Spark derives from them) in
full; no row caps, id subsets or sampling.  Floating outputs are rounded to
6 places on both sides (summation order differs between engines) and
``+ 0.0`` removes negative zeros.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.plans.oracle import with_trials

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rnd(c: Column | str, places: int = 6) -> Column:
    """Round as ``round(x * 10^n) / 10^n`` (half away from zero on the scaled
    double), the way SQL engines round doubles, so ties agree with the oracle."""
    c = F.col(c) if isinstance(c, str) else c
    p = F.lit(float(10 ** places))
    return F.round(c.cast("double") * p) / p + F.lit(0.0)


def r6(c: Column | str) -> Column:
    return rnd(c, 6)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every DOUBLE column (compare hygiene for the oracle)."""
    return df.select(*[
        rnd(f.name, places).alias(f.name)
        if f.dataType.typeName() in ("double", "float") else F.col(f.name)
        for f in df.schema.fields])


def sql_r6(expr: str, alias: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6) + 0e0 AS {alias}"


# Importing the query modules fills QUERIES / ORACLE.
QUERY_MODULES = ["q_features", "q_quality", "q_evaluate", "q_drift", "q_events",
                 "q_store", "q_ml", "q_streams"]


def load_all() -> None:
    import importlib
    import importlib.util
    for m in QUERY_MODULES:
        name = f"trialframe.plans.{m}"
        if importlib.util.find_spec(name) is not None:
            importlib.import_module(name)
