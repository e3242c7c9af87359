"""Versioned feature table, registry and file fingerprints.

Upsert: new rows and the stored rows of the same version are unioned and
the latest row per key is kept with ``max`` over a (created_at, seq, row)
struct -- an aggregate with map-side partial results, so a key with many
versions collapses before the shuffle (a ``row_number`` window would hold a
hot key's rows in one task).  The version partition is then replaced with
dynamic partition overwrite, written to a new path first (never overwrite
a path that the same plan reads).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.sources.tables import table_exists


def latest_per_key(df: DataFrame, key: list[str], order: str = "created_at",
                   tiebreak: str | None = None) -> DataFrame:
    """The newest row per key (ties broken by ``tiebreak``, larger wins)."""
    rest = [c for c in df.columns if c not in key]
    lead = [order] + ([tiebreak] if tiebreak else [])
    others = [c for c in rest if c not in lead]
    packed = F.struct(*[F.col(c) for c in lead + others]).alias("_r")
    g = df.groupBy(*key).agg(F.max(packed).alias("_r"))
    return g.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def upsert(existing: DataFrame | None, new: DataFrame, key: list[str]) -> DataFrame:
    """S8 (plan only): rows of ``new`` replace rows of ``existing`` with the same key
    when they are newer; ``_seq`` orders the two inputs for equal timestamps."""
    n = new.withColumn("_seq", F.lit(1))
    u = n if existing is None else existing.withColumn("_seq", F.lit(0)).unionByName(n)
    return latest_per_key(u, key, "created_at", "_seq").drop("_seq")


def save_feature_set(spark: SparkSession, root: str, name: str, version: str, features: DataFrame,
                     key: str, created_at: str, description: str = "") -> str:
    """Upsert a feature set version into ``root/data`` and add a catalog row.

    Rows are stored with their features as a JSON text (``to_json``) under
    (name, version) partitions; returns the path of the new data snapshot.
    """
    rows = features.select(
        F.col(key).alias("key"), F.lit(name).alias("name"), F.lit(version).alias("version"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
        F.to_json(F.struct(*[c for c in features.columns if c != key])).alias("features_json"))
    data = f"{root}/data"
    old = None
    if table_exists(spark, data):
        old = spark.read.parquet(data).filter((F.col("name") == name) & (F.col("version") == version))
    merged = upsert(old, rows, ["key", "name", "version"])
    snap = f"{root}/staging/{name}-{version}-{created_at.replace(' ', 'T').replace(':', '')}"
    merged.write.mode("overwrite").parquet(snap)          # a new path: never overwrite what we read
    (spark.read.parquet(snap).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("name", "version").parquet(data))
    cat = spark.read.parquet(snap).agg(F.count(F.lit(1)).cast("long").alias("n_samples")).select(
        F.lit(name).alias("name"), F.lit(version).alias("version"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"), "n_samples",
        F.lit(len(features.columns) - 1).alias("n_features"),
        F.array(*[F.lit(c) for c in features.columns if c != key]).alias("feature_names"),
        F.lit(description).alias("description"))
    cat.write.mode("append").parquet(f"{root}/catalog")
    return snap


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """K5 + L7: feature sets newest first; one row per (name, version), latest entry wins."""
    c = latest_per_key(spark.read.parquet(f"{root}/catalog"), ["name", "version"])
    return c.orderBy(F.desc("created_at"), F.desc("version"))


def latest_version(cat: DataFrame) -> DataFrame:
    """Newest version per feature-set name."""
    return cat.groupBy("name").agg(F.max_by("version", F.struct("created_at", "version")).alias("version"),
                                   F.max("created_at").alias("created_at"))


# The registry entry: 13 fields.
REGISTRY_SCHEMA = (
    "model_name string, version string, model string, registered_at string, model_path string, "
    "qualified_for_production boolean, best_f1 double, iq_passed boolean, oq_passed boolean, pq_passed boolean, "
    "feature_columns array<string>, feature_version string, run_id string")


def registry_entry(spark: SparkSession, **fields) -> DataFrame:
    """One registry row; fields left out are null."""
    names = [f.split()[0] for f in REGISTRY_SCHEMA.split(", ")]
    unknown = set(fields) - set(names)
    if unknown:
        raise ValueError(f"no such registry fields: {sorted(unknown)}")
    return spark.createDataFrame([tuple(fields.get(n) for n in names)], REGISTRY_SCHEMA)


def register_model(spark: SparkSession, root: str, entry: DataFrame) -> None:
    """Append registry entries; unqualified entries are refused."""
    bad = entry.filter(~F.coalesce("qualified_for_production", F.lit(False))).count()
    if bad:
        raise ValueError(f"{bad} unqualified registry entries refused")
    entry.write.mode("append").parquet(f"{root}/registry")


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(f"{root}/registry")


def current_model(history: DataFrame) -> DataFrame:
    """The production pointer = newest qualified entry per model name."""
    q = history.filter(F.col("qualified_for_production"))
    return latest_per_key(q.withColumnRenamed("registered_at", "created_at"), ["model_name"]) \
        .withColumnRenamed("created_at", "registered_at")


MD5_MAX_BYTES = 64 << 20     # larger files do not fit a row: they get a hash over their lines instead of an md5
LINE_BASE, LINE_PRIME = 0x9E3779B97F4A7C15F39CC0605CEDC835, (1 << 127) - 1


def files(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """(name, path, size, modified) of the files of a directory; contents are not read."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return f.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path",
                    F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def line_hashes(spark: SparkSession, directory: str, pattern: str, over_bytes: int) -> DataFrame:
    """(path, line_hash) of the files over ``over_bytes``: a hash of all their bytes, line by line and in order.

    Each task folds the lines of its part of a file into a polynomial; the parts are then put together in
    file order, so the hash does not depend on how a file was split.  ``line_hash`` is "lines:hash".
    """
    lines = (spark.read.format("text").option("lineSep", "\n").option("pathGlobFilter", pattern).load(directory)
             .where(F.col("_metadata.file_size") > over_bytes)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                     F.unhex(F.md5(F.col("value").cast("binary"))).alias("line")))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple[int, int]] = {}
        for batch in batches:
            for path, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, h = held.get((path, start), (0, 0))
                held[path, start] = n + 1, (h * LINE_BASE + int.from_bytes(line)) % LINE_PRIME
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in held], pa.string()), pa.array([s for _, s in held], pa.int64()),
             pa.array([n for n, _ in held.values()], pa.int64()), pa.array([f"{h:032x}" for _, h in held.values()], pa.string())],
            names=["path", "start", "n", "h"])

    def joined(table: pa.Table) -> pa.Table:        # a row for each part of one file
        n, h = 0, 0
        for row in table.sort_by("start").to_pylist():
            n, h = n + row["n"], (h * pow(LINE_BASE, row["n"], LINE_PRIME) + int(row["h"], 16)) % LINE_PRIME
        return pa.table({"path": table["path"][:1], "line_hash": pa.array([f"{n}:{h:032x}"], pa.string())})

    return (lines.mapInArrow(fold, "path string, start long, n long, h string")
            .groupBy("path").applyInArrow(joined, "path string, line_hash string"))


def fingerprints(spark: SparkSession, directory: str, pattern: str = "*", max_bytes: int = MD5_MAX_BYTES) -> DataFrame:
    """(name, path, size, md5, modified, line_hash) of the files of a directory; above ``max_bytes``
    ``md5`` is null and ``line_hash`` is given instead."""
    small = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
             .filter(F.col("length") <= max_bytes).select(F.col("path").alias("_p"), F.md5("content").alias("md5")))
    large = line_hashes(spark, directory, pattern, max_bytes).withColumnRenamed("path", "_l")
    f = files(spark, directory, pattern)
    return (f.join(small, F.col("path") == F.col("_p"), "left").join(large, F.col("path") == F.col("_l"), "left")
            .select("name", "path", "size", "md5", "modified", "line_hash"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """One row (n, row_hash): a hash of a table's rows that does not depend on their order or files."""
    h = F.xxhash64(F.to_json(F.struct(*sorted(df.columns))))
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("row_hash"))


def artifact_status(spark: SparkSession, directory: str, expected: list[str]) -> DataFrame:
    """(name, exists, size, modified) for every expected file and every other one that is there."""
    wanted = spark.createDataFrame([(n,) for n in expected], "name string").withColumn("expected", F.lit(True))
    there = files(spark, directory).select("name", "size", "modified", F.lit(True).alias("found"))
    return wanted.join(there, "name", "full_outer").select(
        "name", F.coalesce("expected", F.lit(False)).alias("expected"), F.coalesce("found", F.lit(False)).alias("exists"),
        "size", "modified")


def fingerprint_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per file name, new / gone / changed / same between two fingerprint sets taken with one ``max_bytes``.

    A side has a file when it has its size; the contents differ when the sizes, the md5 or the line hashes do.
    """
    o, n = (f.select("name", F.col("md5").alias(f"{side}_md5"), F.col("size").alias(f"{side}_size"),
                     F.col("line_hash").alias(f"{side}_line_hash")) for side, f in (("old", old), ("new", new)))
    j = o.join(n, "name", "full_outer")
    status = (F.when(F.col("old_size").isNull(), F.lit("new"))
               .when(F.col("new_size").isNull(), F.lit("gone"))
               .when(F.col("old_size") != F.col("new_size"), F.lit("changed"))
               .when(F.col("old_md5") == F.col("new_md5"), F.lit("same"))
               .when(F.col("old_line_hash") == F.col("new_line_hash"), F.lit("same"))
               .when(F.col("old_md5").isNotNull() & F.col("new_md5").isNotNull(), F.lit("changed"))
               .when(F.col("old_line_hash").isNotNull() & F.col("new_line_hash").isNotNull(), F.lit("changed"))
               .otherwise(F.raise_error(F.format_string("%s: no hash of one kind on both sides", "name"))))
    return j.withColumn("status", status)
