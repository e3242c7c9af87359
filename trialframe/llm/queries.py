"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialframe.llm import (bpe, brown_lm, byte_cnn, chat_format, decontam, fim, license_join, line_quality, line_runs, ngram_join,
                            token_align, token_store, toxic_fm)
from trialframe.llm.common import fold_is, read_table
from trialframe.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_documents(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = bpe.decode_documents(encoded.withColumn("ids_sha256", F.sha2("ids", 256)), ranks, "n_tokens", "ids_sha256")
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan_documents(read_table(spark, sf_dir, "documents")).drop("n_blocks")


def _license_sql() -> str:
    """Every window that starts at a template word, by lists."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    phrases = []
    for phrase, label in license_join.PHRASES:
        words = phrase.split()
        test = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
        phrases.append(f"SELECT doc_id, '{label}' AS label, i FROM (SELECT doc_id, w, unnest(range(len(w) - {len(words) - 1})) AS i "
                       f"FROM words WHERE len(w) >= {len(words)}) WHERE {test}")
    templates = ", ".join(f"('{label}', {license_join.span_of(wording)}, [{', '.join(map(repr, license_join.template_words(wording)))}])"
                          for label, wording in license_join.TEMPLATES)
    return f"""
WITH words AS (SELECT doc_id, regexp_extract_all({low}, {word}) AS w FROM documents),
places AS ({' UNION ALL '.join(phrases)}),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id),
templates(label, span, t) AS (VALUES {templates}),
starts AS (SELECT label, span, t, doc_id, w, unnest(list_filter(range(len(w)), lambda i: list_contains(t, w[i + 1]))) AS i
  FROM words, templates),
hits AS (SELECT doc_id, label, len(list_intersect(w[i + 1:i + span], t)) / len(t) AS containment FROM starts
  WHERE len(list_intersect(w[i + 1:i + span], t)) >= ceil({license_join.THRESHOLD} * len(t) - 1e-9)),
best AS (SELECT doc_id, max(containment) AS best FROM hits GROUP BY doc_id),
found AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM hits UNION ALL SELECT doc_id, label FROM places) GROUP BY doc_id)
SELECT d.doc_id, len(words.w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM documents d JOIN words USING (doc_id) LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN found USING (doc_id)
"""


ORACLE["op2_license_scan"] = _license_sql()


@register
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(read_table(spark, sf_dir, "documents"), words=3, percent=90)


@register
def op5_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score_documents(read_table(spark, sf_dir, "documents"), fold_is("doc_id", 1))


@register
def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(read_table(spark, sf_dir, "documents"), "source").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_words", "depleted")


_SPACE, _WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
ORACLE["op6_line_rules"] = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
words AS (SELECT doc_id, host, text, regexp_extract_all(text, '{_WORD}') AS w FROM docs),
windows AS (SELECT doc_id, i, array_to_string(w[i + 1:i + {line_quality.WINDOW}], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(len(w) - {line_quality.WINDOW - 1})) AS i FROM words WHERE len(w) >= {line_quality.WINDOW})),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range({line_quality.WINDOW}) AS r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM docs),
full_lines AS (SELECT doc_id, host, text, line, len(regexp_extract_all(line, '{_WORD}')) AS n,
  trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}', ' ', 'g'), ' ') AS norm
  FROM lines WHERE regexp_matches(line, '{_WORD}')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id),
host_docs AS (SELECT host, count(DISTINCT text) AS n FROM docs GROUP BY host),
often AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT text) AS n FROM full_lines GROUP BY host, norm) f
  JOIN host_docs h USING (host) WHERE f.n > {line_quality.MIN_DOCS} AND (f.n > {line_quality.SHARE} * h.n OR f.n > {line_quality.MANY})),
lost AS (SELECT doc_id, sum(n) AS n FROM full_lines JOIN often USING (host, norm) GROUP BY doc_id),
facts AS (SELECT doc_id, len(w) AS n_words, len(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
  len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS removed_words
  FROM words LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN lost USING (doc_id)),
judged AS (SELECT *, n_words < {line_quality.MIN_WORDS} OR 100 * n_repeat_words > {int(100 * line_quality.MAX_REPEAT)} * n_words AS base_failed,
  removed_words > 0 AND (n_words - removed_words < {line_quality.MIN_WORDS}
    OR n_words - removed_words < {line_quality.MIN_KEPT} * n_words) AS depleted FROM facts)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM judged
"""


@register
def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.write_tokens(read_table(spark, sf_dir, "documents"),
                                    scratch_path(spark, f"op7-tokens-{uuid.uuid4().hex}"),
                                    public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_store.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said)
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    back = chat_format.parse_chats(chat_format.format_chats(turns))
    rows = F.flatten(F.transform("turns", lambda t: F.transform(
        t["parts"], lambda p: F.concat(t["role"], F.lit("\n"), p, F.lit("\n")))))
    return (back.withColumn("rows_back", rows)
            .select("conv_id", F.size("rows_back").cast("long").alias("n_turns"),
                    F.sha2(chat_format.join_text(F.col("rows_back")), 256).alias("turns_sha256"),
                    F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"), F.col("n_turns").alias("n_merged")))


_ESCAPED = "length({0}) + length(regexp_replace({0}, '[^\\\\<\\[|]', '', 'g'))"
ORACLE["op8_chat_format"] = f"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, CASE WHEN role = lag(role) OVER w THEN 0 ELSE 1 END AS opens FROM rows_
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_ESCAPED.format('text')} + CASE WHEN opens = 1 THEN {_ESCAPED.format('role')} + 16 ELSE 8 END) AS BIGINT) AS formatted_chars,
  CAST(sum(opens) AS BIGINT) AS n_merged
FROM marked GROUP BY conv_id
"""


@register
def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = read_table(spark, sf_dir, "documents"), fold_is("doc_id", 0)
    model = byte_cnn.fit(docs, read_table(spark, sf_dir, "labels"), "quality", ~fold)
    return byte_cnn.score(docs.select("doc_id", "text", fold.alias("held_out")), model, "held_out").withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int"))


@register
def op10_factor_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = read_table(spark, sf_dir, "documents"), fold_is("doc_id", 0)
    model = toxic_fm.fit(docs, read_table(spark, sf_dir, "labels"), "toxic", ~fold)
    return toxic_fm.score(docs.select("doc_id", "text", fold.alias("held_out")), model, "held_out").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


@register
def op11_fim_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.restore(fim.transform(read_table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


@register
def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.dedup_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_BARE = r"regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')"
ORACLE["op12_line_runs"] = rf"""
WITH split_ AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
lines AS (SELECT doc_id, unnest(a) AS line, unnest(range(len(a))) AS place FROM split_),
keyed AS (SELECT doc_id, place, line, translate({_BARE}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= {line_runs.MIN_CHARS} GROUP BY k),
judged AS (SELECT keyed.*, coalesce(owner <> doc_id, false) AS goes FROM keyed LEFT JOIN owners USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@register
def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                       public_tokenizers.path("piece_bpe_32k.model"))
