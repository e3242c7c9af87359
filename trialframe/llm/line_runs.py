"""Line dedup against levelled sorted runs of line hashes, by DataFrame functions only.

``dedup_lines(docs)`` removes every line whose key also stands in a document of smaller id.  A
line's key is the line without white space (``[\\x20\\x09-\\x0D]``) at its ends and with A-Z lower-cased; keys
of fewer than ``MIN_CHARS`` code points are never removed.

1. Each line becomes one small row: document, place, two 64-bit hashes of the key.
2. The documents arrive in batches (ranges of ascending ids, or what the caller brings with
   ``LineRuns.add``).  A batch is reduced to its distinct keys before anything is joined, so a line that a
   third of all documents hold is one row.
3. ``LineRuns`` keeps the keys seen so far as sorted runs: tables bucketed by hash and sorted within each
   bucket, with the document that owns each key.  A batch is merge-joined with every run, which moves only the batch; keys
   that no run has form a run of level 0.  When a level holds ``FAN_IN`` runs they are compacted into one run of
   the next level, so a batch meets a logarithmic number of runs.
4. Keys that stand in several documents are joined back to the lines, and the places that go are cut out
   of the texts.

The first batch that brings a key owns it, and within a batch the smallest id.  Keys are identified by their 128 bits.

Defined cases: a null or empty text is one empty line, which stays; rows that share an id are one document, each with its own
lines; a row without an id owns nothing and loses the lines that documents with an id hold; ids that are not
numbers form one batch; an empty table gives no rows and no run; extra columns pass by.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from trialframe.llm.common import counted_table, id_text, shared_table
from trialframe.session import scratch_path

MIN_CHARS = 10
BATCHES = 4
FAN_IN = 2
SPACE = " \t\x0b\x0c\r"       # within a line
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


class LineRuns:
    """Keys of lines seen so far: ``runs`` lists (level, folder) of sorted runs under the shared folder.

    The list is plain data: ``LineRuns(spark, runs)`` goes on from a saved one.
    """

    def __init__(self, spark: SparkSession, runs: list[tuple[int, str]] = (), fan_in: int = FAN_IN):
        self.spark, self.runs, self.fan_in = spark, list(runs), fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(self, path: str) -> DataFrame:
        """A run with its buckets, so that joins leave it where it is."""
        kind, buckets = self.spark.read.parquet(path).schema["owner"].dataType.simpleString(), path.rsplit("-", 1)[1]
        name = "line_run_" + path.rsplit("/", 1)[1].replace("-", "_")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (h1 BIGINT, h2 BIGINT, owner {kind}) USING parquet "
                       f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def write(self, rows: DataFrame, level: int) -> None:
        run = f"{uuid.uuid4().hex}-{self.buckets}"
        path, name = scratch_path(self.spark, f"line-runs/{run}"), "line_run_" + run.replace("-", "_")
        (rows.select(*KEY, "owner").repartition(self.buckets, *KEY).write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", path).saveAsTable(name))
        self.runs.append((level, path))

    def compact(self) -> None:
        """Merge the runs of each full level; their keys are distinct."""
        level = 0
        while full := [r for r in self.runs if r[0] == level]:
            if len(full) >= self.fan_in:
                rows = self.read(full[0][1])
                for _, path in full[1:]:
                    rows = rows.unionByName(self.read(path))
                self.runs = [r for r in self.runs if r[0] != level]
                self.write(rows, level + 1)
            level += 1

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of lines (doc_id, h1, h2); returns (h1, h2, owner) of its keys that stand in several documents."""
        keys = lines.where("doc_id is not null").groupBy(*KEY).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        bare = lines.where("doc_id is null").select(*KEY).distinct().select(
            *KEY, *[F.lit(None).cast(lines.schema["doc_id"].dataType).alias(c) for c in ("first", "last")])
        met, owners = keys.unionByName(bare).groupBy(*KEY).agg(F.min("first").alias("first"), F.max("last").alias("last"),
                                                               F.bool_or(F.col("first").isNull()).alias("bare")), []
        for i, (_, path) in enumerate(self.runs):
            run = self.read(path).select(*KEY, F.col("owner").alias(f"owner_{i}"))
            met = met.join(run.hint("merge"), KEY, "left")
            owners.append(f"owner_{i}")
        known = F.coalesce(*owners, F.lit(None)) if owners else F.lit(None)
        owner = F.coalesce(*owners, "first")
        met = met.select(*KEY, owner.alias("owner"), (known.isNull() & F.col("first").isNotNull()).alias("fresh"),
                         (F.coalesce(owner != F.col("first"), F.lit(False)) | F.coalesce(F.col("first") != F.col("last"), F.lit(False))
                          | F.col("bare")).alias("again"))
        met, facts = counted_table(met, "line-keys", fresh=F.count_if("fresh"))
        if facts["fresh"]:
            self.write(met.where("fresh"), 0)
            self.compact()
        return met.where("again and owner is not null").select(*KEY, "owner")


def id_ranges(docs: DataFrame, batches: int) -> Column:
    """Number of the batch of each row: ranges of ascending ids; rows without an id come last."""
    if not isinstance(docs.schema["doc_id"].dataType, NumericType) or batches < 2:
        return F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    number = F.lit(0)
    for cut in cuts:
        number = number + F.when(F.col("doc_id") > cut, 1).otherwise(0)
    return F.when(F.col("doc_id").isNull(), batches).otherwise(number)


def dedup_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS, store: LineRuns | None = None) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) with the text's remaining lines, one row per row of ``docs``."""
    spark = docs.sparkSession
    store = store or LineRuns(spark)
    texts = id_text(docs).withColumn("t", F.xxhash64("text"))
    batch = id_ranges(docs, batches)
    split = texts.select("doc_id", "t", batch.alias("batch"), F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    keyed = split.select("doc_id", "t", "batch", "place", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    lines = shared_table(keyed.select("doc_id", "t", "batch", "place", F.xxhash64("key").alias("h1"),
                                      F.xxhash64(F.lit("line"), "key").alias("h2")), "lines")
    again = None
    for b in range(batches + 1):
        found = store.add(lines.where(F.col("batch") == b)).withColumn("batch", F.lit(b))
        again = found if again is None else again.unionByName(found)
    goes = (lines.join(again, ["batch", *KEY]).where(~F.col("doc_id").eqNullSafe(F.col("owner")))
            .groupBy(F.col("doc_id").alias("d"), F.col("t").alias("dt"))
            .agg(F.array_sort(F.collect_set("place")).alias("places")))                 # the lines of one document
    rows = texts.join(goes.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("dt")), "left")
    all_lines = F.split("text", "\n", -1)
    starts = F.concat(F.array(F.lit(-1)), "places")
    ends = F.concat("places", F.array(F.size(all_lines)))
    kept = F.flatten(F.zip_with(starts, ends, lambda a, z: F.slice(F.col("all_lines"), a + 2, z - a - 1)))
    return (rows.withColumn("all_lines", all_lines)
            .select("doc_id", F.size("all_lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")))
