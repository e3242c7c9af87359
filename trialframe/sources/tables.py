"""Schemas, readers and writers for trial tables.

The trial table has 17 numeric measures, a 0/1 label, an id, a batch id and
an ingestion time.  ``trials`` projects the driver's star schema onto that
shape with one declarative join, so Catalyst prunes the scans to the dozen
columns used and picks the join strategy from table sizes.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order of the raw trial row, the measures, the
# allowed doses and the label law (weights and threshold).
MEASURES = [
    "mol_weight", "logp", "tpsa", "hbd", "hba", "rotatable_bonds", "aromatic_rings",
    "patient_age", "patient_weight_kg", "creatinine_clearance", "is_male",
    "baseline_crp", "baseline_il6", "baseline_tnfa", "baseline_wbc",
    "dose_mg", "treatment_days",
]
LABEL = "efficacy_label"
ID = "sample_id"
RAW_COLUMNS = MEASURES + [LABEL, ID, "batch_id", "ingestion_timestamp"]
DOSES = [25.0, 50.0, 100.0, 200.0, 400.0]
LABEL_THRESHOLD = 0.45

TRIAL_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in MEASURES]
    + [
        T.StructField(LABEL, T.IntegerType(), True),
        T.StructField(ID, T.StringType(), True),
        T.StructField("batch_id", T.StringType(), True),
        T.StructField("ingestion_timestamp", T.TimestampNTZType(), True),
    ]
)

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet; filters and projections reach the scan)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """pandas treats NaN as missing; Spark does not.  Map NaN to null on read."""
    cols = cols if cols is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def label_score(lipinski_ok: Column, dose: Column, days: Column, crp: Column,
                crcl: Column, noise: Column) -> Column:
    """The weighted score behind the efficacy label (fixed weights)."""
    return (F.lit(0.30) * lipinski_ok
            + F.lit(0.15) * (dose / F.lit(400.0))
            + F.lit(0.10) * (days / F.lit(90.0))
            + F.lit(0.10) * (F.lit(1.0) - crp / F.lit(80.0))
            + F.lit(0.10) * (crcl / F.lit(150.0))
            + F.lit(0.25) * noise)


def label_from_score(score: Column, threshold: float = LABEL_THRESHOLD) -> Column:
    return (score > F.lit(threshold)).cast("int")


def lipinski_ok(mw: Column, logp: Column, hbd: Column, hba: Column) -> Column:
    return ((mw <= 500) & (logp <= 5) & (hbd <= 5) & (hba <= 10)).cast("double")


def trials(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """The raw trial table as a projection of lineitem/orders/part/customer.

    Columns: the 21 raw columns, plus ``row_key`` (unique), ``noise`` (the
    label's random term) and ``side`` (reference / production).  A streaming
    ``lineitem`` may be passed: the dimension joins are then stream-static.
    """
    li = lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    # customers meet the orders, not the lines, and parts come before the wider orders: two shuffles of the lines instead of three
    j = (li.join(p, li.l_partkey == p.p_partkey)
           .join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey))
    dbl = lambda e: e.cast("double")
    cols = {
        "row_key": F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "mol_weight": F.lit(100.0) + F.col("l_extendedprice") / F.lit(175.0),
        "logp": F.col("l_tax") * F.lit(100.0) - F.lit(2.0),
        "tpsa": F.lit(20.0) + F.lit(180.0) * (F.col("o_totalprice") / F.lit(500000.0)),
        "hbd": dbl(F.col("l_linenumber") % 7),
        "hba": dbl(F.col("p_size") % 13),
        "rotatable_bonds": dbl(F.col("p_size") % 15),
        "aromatic_rings": dbl(F.col("l_partkey") % 5),
        "patient_age": dbl(F.lit(18) + F.col("l_suppkey") % 62),
        "patient_weight_kg": F.lit(40.0) + F.lit(110.0) * ((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0)),
        "creatinine_clearance": F.lit(15.0) + F.lit(2.7) * F.col("l_quantity"),
        "is_male": dbl(F.col("o_custkey") % 2),
        "baseline_crp": F.lit(800.0) * F.col("l_discount"),
        "baseline_il6": F.lit(200.0) * (F.lit(1.0) - F.col("o_totalprice") / F.lit(500000.0)),
        "baseline_tnfa": F.lit(3.0) * (F.col("p_retailprice") - F.lit(900.0)),
        "baseline_wbc": F.lit(2.0) + F.lit(18.0) * (F.col("l_quantity") / F.lit(50.0)),
        "dose_mg": F.element_at(F.array(*[F.lit(d) for d in DOSES]),
                                (F.col("l_partkey") % 5 + 1).cast("int")),
        "treatment_days": dbl(F.lit(7) + F.col("l_orderkey") % 83),
        "noise": dbl((F.col("l_partkey") * 7919) % 1000) / F.lit(1000.0),
        "sample_id": F.concat(F.lit("SAMPLE_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                              F.col("l_linenumber").cast("string")),
        "batch_id": F.concat(F.lit("BATCH_"), F.col("l_returnflag")),
        "ingestion_timestamp": F.col("l_shipdate"),
        "side": F.when(F.col("l_linestatus") == "F", F.lit("reference")).otherwise(F.lit("production")),
    }
    t = j.select(*[e.alias(k) for k, e in cols.items()])
    score = label_score(lipinski_ok(F.col("mol_weight"), F.col("logp"), F.col("hbd"), F.col("hba")),
                        F.col("dose_mg"), F.col("treatment_days"), F.col("baseline_crp"),
                        F.col("creatinine_clearance"), F.col("noise"))
    t = t.withColumn(LABEL, label_from_score(score))
    return t.select("row_key", *RAW_COLUMNS, "noise", "side")


# --- file sources and sinks (S1, S2, S4, S5) --------------------------------

def read_trials(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a trial table with the fixed schema (no inference)."""
    if fmt == "csv":
        df = (spark.read.schema(TRIAL_SCHEMA).option("header", True)
              .option("mode", "PERMISSIVE").csv(path))
    else:
        df = spark.read.parquet(path)
    return nan_to_null(df, [c for c in MEASURES if c in df.columns])


def write_trials(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table; an ``s3a://`` path goes to the object store."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Path exists on the cluster's file system (local, HDFS or s3a)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON report sink (one JSON object per row)."""
    df.coalesce(1).write.mode(mode).json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON report source; a given schema avoids the inference pass."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)
