"""Quality rules by cross-document line frequency.

``judge(docs, host)`` looks at every line of every document:

* lines are normalised (A-Z lower-cased, white space collapsed) and hashed;
* for each host the distinct documents that hold a line are counted.  Exact copies
  count once, so a text that was merely copied does not make its own lines frequent;
* a line held by more than ``MIN_DOCS`` documents is above the limit and is removed if these are more than ``SHARE`` of
  its host's documents, or more than ``MANY`` whatever the host's size;
* a document is depleted, and rejected, when it loses words and keeps fewer than
  ``MIN_WORDS`` of them or less than ``MIN_KEPT`` of what it had.

Base rules besides: at least ``MIN_WORDS`` words, at most ``MAX_REPEAT`` of them in
repeated windows of ``WINDOW`` words.  ``clean(docs, verdicts)`` applies the decisions:
frequent lines leave the texts and rejected documents go.

Counts are aggregated before every shuffle, so a hot host or line is a row a task.
Only hashes travel; texts move once, in ``clean``.

Defined cases: null text = empty text = no words (rejected); a null host is the
host ''; a null ``doc_id`` is kept; rows that share id and text get the
same verdict; empty tables give empty results; extra columns are ignored by ``judge`` and
kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from trialframe.llm.common import map_batches, shared_table, slices, unused

MIN_DOCS, SHARE = 10, 0.1
MANY = 500              # documents of one host that make a line frequent whatever their share of the host
MIN_WORDS, MIN_KEPT = 20, 0.5
WINDOW, MAX_REPEAT = 8, 0.3
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\r\x0b\x0c"


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def line_key(line: bytes) -> int:
    """Signed 64-bit hash of the normalised line."""
    return signed(xxhash.xxh3_64_intdigest(b" ".join(line.lower().split())))


class WordHashes(dict):
    """word -> 64-bit hash, forgotten from time to time."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` consecutive word hashes."""
    out = h[: len(h) - width + 1].copy()
    for k in range(1, width):
        out ^= out >> np.uint64(31)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[k: len(h) - width + 1 + k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def repeated_words(h: np.ndarray, width: int) -> int:
    """Words that stand in a window of ``width`` words found twice or more."""
    if len(h) <= width:
        return 0
    _, which, n = np.unique(window_hashes(h, width), return_inverse=True, return_counts=True)
    edge = np.zeros(len(h) + 1, dtype=np.int64)
    twice = np.flatnonzero(n[which] > 1)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def line_table(docs: DataFrame, host: str) -> DataFrame:
    """(doc_id, host, h, the base counts, lines array<long>, line_words array<int>); ``h`` hashes the text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"))

    def make():
        hashes = WordHashes()

        def one(text: str) -> tuple:
            data = text.encode()
            lines = data.split(b"\n")
            words = [line.split() for line in lines]
            seen: set[bytes] = set()
            dup = 0
            for line, held in zip(lines, words, strict=True):
                if held:
                    dup += line in seen
                    seen.add(line)
            h = np.array([hashes[w] for held in words for w in held], dtype=np.uint64)
            spaces = sum(text.count(c) for c in SPACES)
            keys = [(line_key(line), len(held)) for line, held in zip(lines, words, strict=True) if held]
            return (signed(xxhash.xxh3_64_intdigest(data)), len(h), len(text) - spaces, sum(text.count(c) for c in SYMBOLS), dup,
                    repeated_words(h, WINDOW), [k for k, _ in keys], [n for _, n in keys])

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                got = list(zip(*map(one, part.column("text").to_pylist()), strict=True))
                kinds = [pa.int64()] * 6 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("host"), *(pa.array(x, t) for x, t in zip(got, kinds, strict=True))],
                    names=["doc_id", "host", "h", *(s.split()[0] for s in STATS.split(", ")), "lines", "line_words"])
        return step

    return map_batches(rows, make, f"doc_id {kind}, host string, h long, {STATS}, lines array<long>, line_words array<int>")


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, many: int = MANY) -> DataFrame:
    """(host, line, n_docs) above the limits, from a ``line_table``."""
    held = lines.select("host", "h", F.explode(F.array_distinct("lines")).alias("line"))
    often = held.groupBy("host", "line").agg(F.count_distinct("h").alias("n_docs")).where(F.col("n_docs") > min_docs)
    hosts = lines.groupBy("host").agg(F.count_distinct("h").alias("host_docs"))
    return often.join(hosts, "host").where(
        (F.col("n_docs") > share * F.col("host_docs")) | (F.col("n_docs") > many)).select("host", "line", "n_docs")


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``removed_words``, ``removed_lines``, ``depleted``, ``kept``."""
    lines = shared_table(line_table(docs, host), "lines")
    often = frequent_lines(lines)
    once = lines.dropDuplicates(["doc_id", "h", "host"])     # repeated rows share a verdict
    lost = (once.select("doc_id", "h", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
            .select("doc_id", "h", "host", F.col("l.lines").alias("line"), F.col("l.line_words").alias("n"))
            .join(often.select("host", "line"), ["host", "line"])
            .groupBy("doc_id", "h", "host").agg(F.sum("n").alias("removed_words"), F.collect_set("line").alias("removed_lines"))
            .withColumnsRenamed({"doc_id": "l_id", "h": "l_h", "host": "l_host"}))
    both = lines.drop("lines", "line_words").join(
        lost, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("h") == F.col("l_h")) & (F.col("host") == F.col("l_host")), "left")
    removed = F.coalesce("removed_words", F.lit(0).cast("long"))
    left = F.col("n_words") - removed
    out = both.select("doc_id", "h", "host", *(s.split()[0] for s in STATS.split(", ")), removed.alias("removed_words"),
                      F.coalesce("removed_lines", F.array().cast("array<long>")).alias("removed_lines"),
                      ((F.col("n_words") < MIN_WORDS)
                       | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEAT) * F.col("n_words"))).alias("base_failed"),
                      ((removed > 0) & ((left < MIN_WORDS) | (left < MIN_KEPT * F.col("n_words")))).alias("depleted"))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


def clean(docs: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """``docs`` without rejected documents and without the removed lines (``n_chars`` follows where it exists)."""
    columns, schema = docs.columns, docs.schema
    gone, h = unused("gone_lines", docs), unused("text_hash", docs)
    decided = verdicts.where("kept").select("doc_id", "h", "host", F.col("removed_lines").alias(gone)).dropDuplicates(["doc_id", "h", "host"])
    keyed = text_hash(docs, h)
    rows = keyed.join(decided, keyed["doc_id"].eqNullSafe(decided["doc_id"]) & (keyed[h] == decided["h"])
                      & (F.coalesce(keyed[host].cast("string"), F.lit("")) == decided["host"])
                      ).select(*(keyed[c] for c in columns), decided[gone])

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                yield cleaned(part)

        def cleaned(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = []
            for text, lines in zip(part.column("text").to_pylist(), part.column(gone).to_pylist(), strict=True):
                if lines and text:
                    held = set(lines)
                    text = "\n".join(x for x in text.split("\n") if not x.strip(SPACES) or line_key(x.encode()) not in held)
                texts.append(text)
            out = {c: part.column(c) for c in columns}
            out["text"] = pa.array(texts, part.schema.field("text").type)
            if "n_chars" in out:
                length = pa.compute.utf8_length(out["text"]).cast(part.schema.field("n_chars").type)
                touched = pa.compute.greater(pa.compute.list_value_length(part.column(gone)), 0)
                out["n_chars"] = pa.compute.if_else(touched, length, out["n_chars"])
            return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
        return step

    return map_batches(rows, make, schema)


def text_hash(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the signed xxh3-64 of the text (null as empty) that ``line_table`` gives."""
    columns, kinds = docs.columns, docs.schema

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                h = [signed(xxhash.xxh3_64_intdigest((x or "").encode())) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(h, pa.int64())], names=[*columns, name])
        return step

    return map_batches(docs, make, StructType([*kinds.fields, StructField(name, LongType())]))
