"""Training under load: even parts for the fits' many short jobs, and no more fits at a time than memory holds."""

import pytest
from pyspark.sql import functions as F

from trialframe.functions.recipe import FEATURE_COLS
from trialframe.ml import train as T
from trialframe.session import cache_bytes, dealt, materialised


def part_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_dealt_rows_come_back_in_several_even_parts_a_core(spark):
    rows = spark.range(0, 150_000, 1, 1).select("id", F.array(*[F.rand(i) for i in range(29)]).alias("v"))      # one large file
    back, plain, cores = dealt(rows, "dealt-test"), materialised(rows, "dealt-test"), spark.sparkContext.defaultParallelism
    sizes = part_sizes(back)
    assert len(part_sizes(plain)) <= cores < 2 * cores < len(sizes)
    assert max(sizes) <= 2.5 * sum(sizes) / len(sizes)
    assert back.schema == plain.schema and back.agg(F.count_distinct("id"), F.sum("id")).first()[:] == (150_000, 150_000 * 149_999 // 2)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None         # the caller's session is as it was


def test_sets_of_fits_as_memory_allows(spark):
    assert cache_bytes(spark) > 0
    assert T.sets_together(10_000, 10**9, 4) == 4
    assert T.sets_together(1_000_000, 5 * 10**9, 4) == 2
    assert T.sets_together(14_000_000, 17 * 10**9, 4) == 0
    assert T.sets_together(0, 10**9, 4) == 4


class Stopped(Exception):
    pass


@pytest.mark.parametrize("memory, expected", [(0, 1), (10**9, 3)])
def test_fits_that_memory_does_not_hold_run_one_by_one(spark, monkeypatch, memory, expected):
    found = []

    def fits(train, estimators, feature_cols=FEATURE_COLS, parallelism=3):
        found.append(parallelism)
        raise Stopped

    monkeypatch.setattr(T, "cache_bytes", lambda spark: memory)
    monkeypatch.setattr(T, "fit_candidates", fits)
    rows = spark.range(40).select(*[F.rand(i).alias(c) for i, c in enumerate(FEATURE_COLS)], (F.col("id") % 2).cast("int").alias(T.LABEL),
                                  (F.col("id") % 5).cast("int").alias("fold"))
    with pytest.raises(Stopped):
        T.compare_models(rows, rows)
    with pytest.raises(Stopped):
        T.cross_validate(rows)
    assert set(found) == {expected}
