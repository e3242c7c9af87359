"""Retrain cooldown gate (W5, T11 batch form).

Rule: a trigger starts a retrain unless an accepted retrain started less
than ``cooldown`` seconds earlier.  The rule is sequential, but what a stretch of
time does with it depends only on the last accepted trigger before the stretch.  So the time
line is cut into chunks of ``CHUNK`` cooldowns:

1. each chunk, on its own, tabulates its last accepted trigger for every possible
   entry.  Entries matter within one cooldown of the chunk's start, and chains from
   neighbouring entries soon meet, so a table has a few rows; triggers too dense to meet make one of at most the
   distinct instants of one cooldown;
2. the tables go up a tree: ``FAN`` neighbours become the table of their block, blocks become larger
   blocks, until one is left.  A block's table again covers entries within one cooldown of its start, so it does not grow
   with the time it covers, and no task reads more than ``FAN`` tables;
3. entries go down the tree: a block that knows its entry tells each of its ``FAN`` parts theirs;
4. each chunk marks its triggers, knowing its entry.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialframe.session import materialised

RETRAIN_COOLDOWN_S = 300
CHUNK = 24
FAN = 32


def _short(upto: np.ndarray, leave: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """A table without the rows that no entry before ``limit`` - cooldown reaches, neighbours of one exit merged."""
    reached = np.append(True, upto[:-1] < limit)
    upto, leave = upto[reached], leave[reached]
    keep = np.append(leave[1:] != leave[:-1], True)
    return upto[keep], leave[keep]


def _rows(pdf: pd.DataFrame, keys: list[str], number: int, upto: np.ndarray, leave: np.ndarray) -> pd.DataFrame:
    head = pdf[keys].iloc[[0] * len(upto)].reset_index(drop=True)
    return head.assign(_chunk=number, _upto=upto, _exit=leave)


def _table(cool: int, keys: list[str]):
    """A chunk's (entry up to, last accepted) rows."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ts = np.sort(pdf["_us"].to_numpy())
        n = len(ts)
        following = np.searchsorted(ts, ts + cool)
        last = np.arange(n)
        while (following[last] < n).any():          # at most CHUNK steps
            last = np.where(following[last] < n, following[np.minimum(last, n - 1)], last)
        chunk = int(pdf["_chunk"].iloc[0])
        return _rows(pdf, keys, chunk, *_short(ts, ts[last], chunk * CHUNK * cool + cool))
    return run


def _parts(pdf: pd.DataFrame):
    """(number, uptos, exits) of each part's table, in order of time."""
    for number, table in pdf.sort_values(["_chunk", "_upto"]).groupby("_chunk", sort=True):
        yield int(number), table["_upto"].to_numpy(), table["_exit"].to_numpy()


def _join(cool: int, keys: list[str], base: int, span: int):
    """The table of a block of neighbouring parts; blocks cover ``span`` chunks and are counted from chunk ``base``."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["_block"].iloc[0])
        limit = (base + block * span) * CHUNK * cool + cool
        upto = leave = np.empty(0, dtype=np.int64)
        for _, u, x in _parts(pdf):
            at = np.searchsorted(u, leave + cool)
            leave = np.where(at < len(u), x[np.minimum(at, len(u) - 1)], leave)
            upto, leave = _short(np.append(upto, u), np.append(leave, x), limit)     # entries past all earlier parts
        return _rows(pdf, keys, block, upto, leave)
    return run


def _enter(cool: int, keys: list[str]):
    """Each part's last accepted trigger before it (null: none), from that of its block."""
    def run(pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        rows, last = [], entry["_last"].iloc[0] if len(entry) else None
        last = None if pd.isna(last) else int(last)
        for number, u, x in _parts(pdf):
            rows.append((number, last))
            at = 0 if last is None else int(np.searchsorted(u, last + cool))
            if at < len(u):
                last = int(x[at])
        out = pd.DataFrame({"_chunk": pd.array([c for c, _ in rows], dtype="int64"),
                            "_last": pd.array([x for _, x in rows], dtype="Int64")})
        return out.assign(**{k: [pdf[k].iloc[0]] * len(out) for k in keys})[[*keys, "_chunk", "_last"]]
    return run


def _mark(cool: int, keys: list[str]):
    """The accepted trigger that covers each trigger (its own time if it is accepted)."""
    def run(pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pdf.assign(_by=pd.Series(dtype="int64"))[[*keys, "_us", "_by"]]
        pdf = pdf.sort_values("_us")
        ts = pdf["_us"].to_numpy()
        last = entry["_last"].iloc[0]
        by = np.empty(len(ts), dtype=np.int64)
        at = 0
        if not pd.isna(last):
            at = int(np.searchsorted(ts, int(last) + cool))
            by[:at] = int(last)
        while at < len(ts):
            stop = int(np.searchsorted(ts, ts[at] + cool))
            by[at:stop] = ts[at]
            at = stop
        return pdf.assign(_by=by)[[*keys, "_us", "_by"]]
    return run


def cover(instants: DataFrame, cooldown_s: int, keys: list[str] | None = None) -> DataFrame:
    """(keys, _us, _by) of distinct instants (keys, _us): the accepted instant that covers each."""
    keys, cool = list(keys or []), cooldown_s * 1_000_000
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in (instants.schema[k] for k in keys))
    i = instants.select(*keys, "_us", F.floor(F.col("_us") / F.lit(CHUNK * cool)).cast("long").alias("_chunk"))
    table, entry = f"{kinds}_chunk long, _upto long, _exit long", f"{kinds}_chunk long, _last long"
    level = materialised(i.groupBy(*keys, "_chunk").applyInPandas(_table(cool, keys), table), "cooldown")
    ends = level.agg(F.min("_chunk").alias("first"), F.max("_chunk").alias("last")).first()
    base, wide, span, levels = ends["first"] or 0, (ends["last"] or 0) - (ends["first"] or 0) + 1, 1, []
    while True:             # level 0 counts chunks from the epoch, the levels above count blocks from the first chunk
        start = 0 if levels else base
        parts = level.withColumn("_block", F.floor((F.col("_chunk") - start) / F.lit(FAN)).cast("long"))
        levels.append(parts)
        span, wide = span * FAN, -(-wide // FAN)
        if wide <= 1:
            break
        level = materialised(parts.groupBy(*keys, "_block").applyInPandas(_join(cool, keys, base, span), table), "cooldown")
    entries = i.sparkSession.createDataFrame([], entry)         # the topmost block of a key has no entry
    for parts in reversed(levels):
        above = entries.withColumnRenamed("_chunk", "_block")
        entries = (parts.groupBy(*keys, "_block").cogroup(above.groupBy(*keys, "_block"))
                   .applyInPandas(_enter(cool, keys), entry))
    return (i.groupBy(*keys, "_chunk").cogroup(entries.groupBy(*keys, "_chunk"))
            .applyInPandas(_mark(cool, keys), f"{kinds}_us long, _by long"))


def apply_cooldown(triggers: DataFrame, cooldown_s: int = RETRAIN_COOLDOWN_S) -> DataFrame:
    """(trigger_id, ts) -> (trigger_id, ts, accepted).  ``trigger_id`` breaks ties."""
    t = triggers.select("trigger_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                        F.unix_micros(F.to_timestamp("ts")).alias("_us"))
    first = t.groupBy("_us").agg(F.min("trigger_id").alias("_first"))
    marks = cover(first.select("_us"), cooldown_s)
    accepted = marks.where(F.col("_us") == F.col("_by")).select("_us").join(first, "_us")       # only the first of an instant
    accepted = accepted.select(F.col("_us").alias("_a_us"), F.col("_first"))
    on = (F.col("_us") == F.col("_a_us")) & (F.col("trigger_id") == F.col("_first"))
    return t.join(accepted, on, "left").select("trigger_id", "ts", F.col("_a_us").isNotNull().alias("accepted"))


def retrain_decisions(verdicts: DataFrame, cooldown_s: int = RETRAIN_COOLDOWN_S) -> DataFrame:
    """Drift verdicts (trigger_id, ts, retrain) -> the same with ``started``: the drift rule asks
    for a retrain and no accepted one started within the cooldown."""
    asked = verdicts.where("retrain").select("trigger_id", "ts")
    allowed = apply_cooldown(asked, cooldown_s).where("accepted").select(F.col("trigger_id").alias("_t"))
    return (verdicts.join(allowed, F.col("trigger_id") == F.col("_t"), "left")
            .withColumn("started", F.col("_t").isNotNull()).drop("_t"))
