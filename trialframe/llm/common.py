"""Shared helpers of the corpus operators.

Conventions that hold for every operator here:

* Documents arrive as a DataFrame with at least ``doc_id`` and ``text``; other
  columns may exist and never clash, because operators select what they need.
* A null text counts as the empty text.  Whole texts are processed.
* Intermediate tables go to the folder named in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trialframe.session import scratch_path


BATCH_BYTES = 4 << 20     # handed to a Python worker at once, by size and not only by rows


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null as empty) and the columns named in ``more``."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def unused(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage; survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted_table(df: DataFrame, name: str, **sums: Column) -> tuple[DataFrame, dict]:
    """``shared_table`` and, from the same job, its row count ``n`` and further aggregates."""
    seen = Observation()
    table = shared_table(df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in sums.items()]), name)
    return table, seen.get


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]],
                schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with per-task state: ``make()`` runs once a task and returns the batch function.

    Batches hold about ``BATCH_BYTES`` (one row at least): this sets the session's ``maxBytesPerBatch``.
    A task's state and freed memory go back to the system at its end.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)
        step = batch = None
        give_back()
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its task, beside those of the next stage,
    and would keep what malloc and Arrow hold in reserve."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``max_bytes`` of one column (one row at least)."""
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        size = size or 0
        if i > start and held + size > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def fold_is(doc_id: str, remainder: int, folds: int = 5):
    """crc32 of the id as text, modulo ``folds``, equals ``remainder`` (a null id counts as the text '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == remainder
