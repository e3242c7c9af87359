"""Chat formatting as a relational plan: DataFrame expressions only.

``format_chats(turns)`` takes rows (conv_id, turn, role, text) and gives one row
per conversation: the formatted string, its turns and the spans under the loss
mask.  Rows of a conversation are collected as structs and sorted by turn (ties:
role, then text); neighbours of the same role are merged into one turn whose
parts stay apart by a ``more`` mark, so nothing is lost:

    <|role:user|>first part<|more|>second part<|end|><|role:assistant|>reply<|end|>

Inside roles and texts, ``\\`` becomes ``\\0``, ``<`` ``\\1``, ``[`` ``\\2`` and ``|``
``\\3``.  No control string can then stand in a text, whether of this template
(``<|...|>``) or of another (``</s>``, ``[INST]``); ``unescape`` undoes it exactly.

``parse_chats`` reads the formatted strings back.  Loss covers the parts of the
roles in ``loss_roles``, without marks.

Defined cases: null text or role = empty; null ``conv_id`` is a conversation of
its own; repeated rows are repeated parts; null turns come first; an empty table
gives an empty table; other columns are ignored.  One conversation's text is one
value, so it must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"), ("|", "\\3"))     # the first is the escape itself
ROLE, CLOSE, MORE, END = "<|role:", "|>", "<|more|>", "<|end|>"


def escape(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def join_text(parts: Column) -> Column:
    return F.concat_ws("", parts)


def format_chats(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, n_rows, n_turns, formatted, loss_spans array<struct<start,length>> in characters)."""
    rows = turns.select("conv_id", F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("row"))
    sorted_rows = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    starts = F.filter(F.sequence(F.lit(0), F.size("rows") - 1), lambda i: (i == 0) | (
        F.element_at("rows", i.cast("int") + 1)["role"] != F.element_at("rows", F.greatest(i.cast("int"), F.lit(1)))["role"]))
    stops = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("rows")))
    merged = F.transform(F.arrays_zip(F.col("starts").alias("a"), stops.alias("z")), lambda s: F.struct(
        F.element_at("rows", s["a"] + 1)["role"].alias("role"),
        F.transform(F.slice("rows", s["a"] + 1, s["z"] - s["a"]), lambda r: escape(r["text"])).alias("parts")))
    # every piece of the output in order, with a flag for the loss mask
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))     # noqa: E731
    off = F.lit(False)
    pieces = F.flatten(F.transform("merged", lambda m: F.concat(
        F.array(piece(F.concat(F.lit(ROLE), escape(m["role"]), F.lit(CLOSE)), off)),
        F.flatten(F.transform(m["parts"], lambda p, i: F.concat(
            F.when(i > 0, F.array(piece(F.lit(MORE), off))).otherwise(F.array().cast("array<struct<text:string,loss:boolean>>")),
            F.array(piece(p, m["role"].isin(*loss_roles)))))),
        F.array(piece(F.lit(END), off)))))
    spans = F.filter(F.aggregate(
        "pieces",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p["text"])).alias("at"),
            F.when(p["loss"], F.concat(s["spans"], F.array(F.struct(
                s["at"].alias("start"), F.length(p["text"]).cast("long").alias("length"))))).otherwise(s["spans"]).alias("spans")),
    )["spans"], lambda x: x["length"] > 0)
    return (sorted_rows.withColumn("starts", starts).withColumn("merged", merged).withColumn("pieces", pieces)
            .select("conv_id", F.size("rows").cast("long").alias("n_rows"), F.size("merged").cast("long").alias("n_turns"),
                    join_text(F.transform("pieces", lambda p: p["text"])).alias("formatted"), spans.alias("loss_spans")))


def parse_chats(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` array<struct<role, parts array<string>>> and ``loss_text`` read from its strings."""
    body = F.split(F.col("formatted"), r"<\|role:")
    turn = lambda s: F.struct(       # noqa: E731
        unescape(F.substring_index(s, CLOSE, 1)).alias("role"),
        F.transform(F.split(F.substring(s, F.length(F.substring_index(s, CLOSE, 1)) + 3, F.length(s)), r"<\|more\|>|<\|end\|>", -1),
                    unescape).alias("parts"))
    turns = F.transform(F.slice(body, 2, F.greatest(F.size(body) - 1, F.lit(0))), turn)
    turns = F.transform(turns, lambda t: F.struct(
        t["role"].alias("role"), F.slice(t["parts"], 1, F.size(t["parts"]) - 1).alias("parts")))     # after the end mark: ""
    return formatted.withColumn("turns", turns).withColumn(
        "loss_text", join_text(F.transform("loss_spans", lambda x: unescape(
            F.substring(F.col("formatted"), (x["start"] + 1).cast("int"), x["length"].cast("int"))))))
