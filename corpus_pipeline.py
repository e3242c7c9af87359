"""Corpus pipeline: documents through quality rules, classifier, near-duplicate join, decontamination and encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's ``docs``.  All but the last keep the columns of ``docs``.

* quality_rules: lines frequent on their host leave the texts; documents that fail the rules go.
* quality_classifier: documents with a probability of good quality under ``MIN_QUALITY`` go.  The
  network learns from the labelled rows of the stage's own input whose crc32 fold is not 0.
* near_duplicates: of documents linked by 5-word shingles at 0.8, the one of the smallest id stays.
* decontamination: documents that hold a benchmark item go.
* encoding: ids of each text, written, then decoded again and compared; a mismatch stops the job.

Null texts count as empty (the rules reject them), tables may be empty, extra columns pass
through, and a column named like one that a stage adds is kept as it is.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.llm import bpe, byte_cnn, decontam, line_quality, ngram_join
from trialframe.llm.common import fold_is, read_table, shared_table
from trialframe.session import scratch_path

MIN_QUALITY = 0.3
BATCH_BYTES = 4 << 20     # of texts handed to a Python worker at once, by size and not only by rows
ORACLE_SQL = None       # a trained network and merge replay are not SQL; tests/llm holds the brute-force check


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return line_quality.clean(docs, line_quality.judge(docs, "source"), "source")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = byte_cnn.fit(docs, read_table(spark, sf_dir, "labels"), "quality", ~fold_is("doc_id", 0))
    return byte_cnn.keep_scored(docs, model, MIN_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.keep_one(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontam.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = docs.select("doc_id", "text", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("text_sha256"))
    # written in between: a core runs one Python worker at a time, not encoder and decoder side by side
    encoded = shared_table(bpe.encode_documents(texts, ranks, public_tokenizers.PATTERN, "text_sha256"), "ids")
    decoded = bpe.decode_documents(encoded, ranks, "text_sha256", "n_tokens", "ids")
    same = F.sha2("decoded", 256) == F.col("text_sha256")
    return decoded.select("doc_id", "n_tokens", F.when(same, F.col("ids")).otherwise(
        F.raise_error(F.format_string("document %s does not decode to its text", "doc_id")).cast("binary")).alias("ids"),
        F.sha2("ids", 256).alias("ids_sha256"))


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("encoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded documents that all stages keep."""
    docs, base = read_table(spark, sf_dir, "documents"), f"pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = scratch_path(spark, f"{base}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
