"""Fill-in-middle: brute force over code points, chunks, memoized summaries, edge rows."""

import hashlib
import random
import re

import numpy as np

from trialframe.llm import fim
from trialframe.llm.queries import op11_fim_chunks

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(tokens[x:y]) for x, y in ((0, a), (a, z), (z, n)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text, text)
    if h4 % 100 < 20:
        return (doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text)
    return (doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text)


def result(docs):
    return sorted(map(tuple, fim.restore(fim.transform(docs)).collect()), key=repr)


def test_equals_brute_force(spark):
    draw = random.Random(5)
    pieces = ["word", "Naïve", " ", "\n", "世界", "😀", "1", "<", "<P", "S>", "<M", "x" * 700, "passage shared by many texts " * 40]
    rows = [(i, "".join(draw.choice(pieces) for _ in range(draw.randint(0, 80)))) for i in range(300)]
    rows += [(300, "a" * 50_000), (301, "<P> holds a marker"), (302, "ends <S>"), (303, None), (304, ""), (5, "again"), (5, "again")]
    got = result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == sorted((brute(i, t) for i, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert result(edge_docs) == sorted((brute(i, t) for i, t in rows), key=repr)
    assert fim.transform(no_docs).count() == 0


def test_every_cut_place():
    text = ("abc déf, 世界x" * 90).encode()
    tokens = TOKEN.findall(text.decode())
    cutter = fim.Cutter()
    (n, places), = cutter.cuts([text], lambda i, n: range(n + 1))
    assert n == len(tokens)
    for k, (at, points) in enumerate(places):
        head = "".join(tokens[:k])
        assert (at, points) == (len(head.encode()), len(head))


def test_shared_passages_are_summarized_once():
    draw = random.Random(1)
    shared = " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(4000)).encode()
    heads = [bytes(draw.choices(range(97, 123), k=200 + 37 * i)) for i in range(8)]
    cutter = fim.Cutter()
    for head in heads:
        list(cutter.cuts([head + shared], lambda i, n: ()))
    assert cutter.summaries.made < 0.4 * cutter.summaries.asked       # chunks find the same borders after any beginning


def test_chunks_see_only_their_text():
    a, b = b"one two three " * 300, b"four five six " * 300
    apart = np.concatenate([fim.chunk_ends(np.frombuffer(a, np.uint8), np.array([len(a)])),
                            fim.chunk_ends(np.frombuffer(b, np.uint8), np.array([len(b)])) + len(a)])
    both = fim.chunk_ends(np.frombuffer(a + b, np.uint8), np.array([len(a), len(a) + len(b)]))
    assert both.tolist() == apart.tolist() and np.diff(np.append(0, both)).max() <= fim.MAX_CHUNK


def test_query_columns(spark, sf_small):
    df = op11_fim_chunks(spark, sf_small)
    assert df.dtypes == [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"),
                         ("output_sha256", "string"), ("restored_sha256", "string")]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()      # noqa: E731
    want = [(*(r := brute(d.doc_id, d.text))[:5], sha(r[5]), sha(r[6])) for d in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
