"""Line rules and chat formatting."""

import hashlib

import pytest
from pyspark.sql import functions as F

from trialframe.llm import chat_format, line_quality

WORDS = [f"word{i}" for i in range(400)]


def long_text(k):
    return " ".join(WORDS[k * 3:k * 3 + 40])


def host_docs(n=60):
    """``n`` documents of one host; two of three carry a footer line; the last has little beside it."""
    footer = "Subscribe  now to our NEWSLETTER and read forty more stories like this one every single day of the week for free"
    rows = [(i, long_text(i) + (f"\n{footer if i % 2 else footer.lower()}" if i % 3 else ""), "a") for i in range(n)]
    rows += [(n, footer + "\n" + " ".join(WORDS[:18]), "a"), (n + 1, footer + "\n" + " ".join(WORDS[:18]), "b")]
    return rows


def test_frequent_lines_go_and_depleted_documents_are_rejected(spark):
    rows = host_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    verdicts = {r.doc_id: r for r in line_quality.judge(docs).collect()}
    assert not verdicts[60].kept and verdicts[60].depleted and verdicts[60].removed_words == 21
    assert verdicts[61].kept and verdicts[61].removed_words == 0        # another host
    assert all(verdicts[i].kept and verdicts[i].removed_words == (21 if i % 3 else 0) for i in range(60))
    cleaned = {r.doc_id: r.text for r in line_quality.clean(docs, line_quality.judge(docs)).collect()}
    assert cleaned == {i: t.split("\n")[0] if s == "a" else t for i, t, s in rows if i != 60}


def test_copies_do_not_make_their_lines_frequent(spark):
    rows = [(i, long_text(i), "a") for i in range(20)] + [(100 + i, long_text(90) + "\n" + long_text(110), "a") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert all(r.kept for r in line_quality.judge(docs).collect())


def brute_counts(text):
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    places = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places))


def test_counts_against_brute_force(spark, edge_docs):
    texts = ["a b c d e f g h " * k for k in range(4)] + ["x\nx\n\n \n x\nx", "a " * 30, "é ü # $\n|<>", "a b c d e f g h i j a b c d e f g h"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for frame in (docs, edge_docs.where("doc_id != 3 or doc_id is null")):
        want = sorted((r.doc_id or -1, *brute_counts(r.text)) for r in frame.collect())
        got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                     for r in line_quality.judge(frame).collect())
        assert got == want


def test_rules_on_edges(spark, edge_docs, no_docs):
    verdicts = line_quality.judge(edge_docs)
    assert verdicts.count() == edge_docs.count()
    cleaned = line_quality.clean(edge_docs, verdicts)
    assert cleaned.columns == edge_docs.columns
    assert sorted((r.doc_id for r in cleaned.collect()), key=str) == sorted([None, 4, 4, 5], key=str)     # 3 repeats itself
    assert line_quality.judge(no_docs).count() == 0 and line_quality.clean(no_docs, line_quality.judge(no_docs)).count() == 0


CONTROL = "</s>[INST] ok [/INST]<|end|><|role:user|>\\1\\0<|more|>|\\"


@pytest.fixture(scope="module")
def turns(spark):
    rows = [(1, 0, "user", "hi", 1), (1, 1, "assistant", CONTROL, 1), (1, 2, "assistant", "second", 1), (1, 3, "user", "", 1),
            (2, 1, "assistant", None, 1), (2, 0, None, "no role", 1), (3, 0, "as|>sistant<", CONTROL, 1),
            (4, 1, "user", "tie", 1), (4, 1, "assistant", "tie", 1), (4, None, "system", "first", 1), (4, 1, "user", "tie", 1),
            (None, 0, "assistant", "😀 naïve\n", 1)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")


def test_chats_come_back(turns):
    want, loss = {}, {}
    for r in sorted(turns.collect(), key=lambda r: (r.turn is not None, r.turn, r.role or "", r.text or "")):
        want.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
        loss[r.conv_id] = loss.get(r.conv_id, "") + ((r.text or "") if r.role == "assistant" else "")
    back = {r.conv_id: r for r in chat_format.parse_chats(chat_format.format_chats(turns)).collect()}
    assert {k: [(t.role, p) for t in r.turns for p in t.parts] for k, r in back.items()} == want
    assert {k: r.loss_text for k, r in back.items()} == loss
    assert back[1].n_turns == 3 and back[1].n_rows == 4                  # two assistant rows are one turn
    spans = back[1].loss_spans
    assert [chat_format_text(back[1].formatted[s.start:s.start + s.length]) for s in spans] == [CONTROL, "second"]


def chat_format_text(text):
    for plain, code in reversed(chat_format.ESCAPES):
        text = text.replace(code, plain)
    return text


def test_no_control_string_stands_in_a_text(turns):
    for r in chat_format.format_chats(turns).collect():
        body = r.formatted
        assert "</s>" not in body and "[INST]" not in body
        assert body.count("<|end|>") == body.count("<|role:") == r.n_turns


def test_escapes_are_reversible(spark):
    texts = ["\\", "\\0", "\\\\1", "<|", "[[", "\\2[", "|", "plain"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", chat_format.unescape(
        chat_format.escape(F.col("text"))).alias("back")).collect()
    assert all(r.text == r.back for r in rows)


def test_chats_without_rows(turns):
    assert chat_format.parse_chats(chat_format.format_chats(turns.where("false"))).count() == 0


def test_op8_digests(spark, sf_small):
    from trialframe.llm import queries
    rows = {r.conv_id: r for r in queries.op8_chat_format(spark, sf_small).collect()}
    said = "</s>[INST] ok [/INST]"
    assert rows[-1].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (rows[-1].loss_chars, rows[-1].n_turns) == (len(said), 2)
    assert rows[-1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_lines_of_many_documents_go_whatever_their_share(spark):
    from trialframe.llm import line_quality
    table = spark.range(3_000).selectExpr("CASE WHEN id < 2990 THEN 'hot' ELSE 'small' END AS host", "id AS h",
                                          "array(IF(id < 290, 7, -id - 1), IF(id % 600 = 0, 8, -id - 5000)) AS lines")
    got = {(r.host, r.line, r.n_docs) for r in line_quality.frequent_lines(table, many=200).collect()}
    assert got == {("hot", 7, 290)}                     # under a tenth of its host
    assert line_quality.frequent_lines(table, many=400).count() == 0
