"""Line dedup by levelled runs: brute force, batches, compaction, edge rows."""

import hashlib

from pyspark.sql import functions as F

from trialframe.llm.line_runs import LineRuns, dedup_lines, line_key

SPACE = " \t\n\x0b\x0c\r"
LOW = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def key(line):
    return line.strip(SPACE).translate(LOW)


def brute(rows):
    """(id, kept text) per row: a null id owns nothing."""
    owner = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                owner[key(line)] = min(i, owner.get(key(line), i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if owner.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)


def test_equals_brute_force(spark):
    rows = [(i, "\n".join([f"line number {i * k % 37:03d} of the text" for k in range(i % 9)]
                          + ["  A Shared LINE of many \t", "short", "", "ünïque wörds %d" % (i % 5), "a shared line OF MANY"])) for i in range(60)]
    rows += [(7, None), (7, ""), (None, "a shared line of many\nonly here in a row without id"), (3, "x" * 100_000 + "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 3, 5):
        assert got(dedup_lines(docs, batches=batches)) == sorted(brute(rows), key=repr)


def test_runs_are_compacted_and_resumed(spark):
    store, seen = LineRuns(spark), []
    for b in range(5):
        rows = [(b, f"line {k} of every batch") for k in range(10)] + [(b, f"line {k} of batch {b} alone") for k in range(3)]
        lines = spark.createDataFrame(rows, "doc_id long, line string").select(
            "doc_id", F.xxhash64(line_key(F.col("line"))).alias("h1"), F.xxhash64(F.lit("line"), line_key(F.col("line"))).alias("h2"))
        seen.append({r.owner for r in store.add(lines).collect()})
        store = LineRuns(spark, [tuple(r) for r in store.runs])        # from the saved list
    assert seen == [set(), {0}, {0}, {0}, {0}]
    assert sorted(level for level, _ in store.runs) == [0, 2]          # 5 = 4 + 1
    assert sum(store.read(path).count() for _, path in store.runs) == 10 + 5 * 3


def test_runs_stay_where_they_are(spark):
    store = LineRuns(spark)
    store.write(spark.range(100).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.col("id").alias("owner")), 0)
    run = store.read(store.runs[0][1])
    batch = spark.range(50).select(F.col("id").alias("h1"), F.col("id").alias("h2")).groupBy("h1", "h2").count()
    plan = batch.join(run.hint("merge"), ["h1", "h2"], "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and f"Bucketed: true" in plan


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got(dedup_lines(edge_docs)) == sorted(brute(rows), key=repr)
    assert dedup_lines(no_docs).count() == 0
    text_ids = edge_docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert dedup_lines(text_ids).count() == len(rows)


def test_query_columns(spark, sf_small):
    from trialframe.llm.queries import op12_line_runs
    df = op12_line_runs(spark, sf_small)
    assert df.dtypes == [("doc_id", "bigint"), ("n_lines", "bigint"), ("n_dropped", "bigint"), ("kept_sha256", "string")]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect()} == want
