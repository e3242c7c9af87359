"""Cross-tokenizer alignment: whole texts through the libraries against words, runs and merges."""

import hashlib
from collections import Counter

import numpy as np
import pytest

import public_tokenizers
from trialframe.llm import token_align
from trialframe.llm.queries import op13_token_align

A_JSON, B_MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A_JSON)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_MODEL)


def unicode_to_byte():
    from tokenizers.pre_tokenizers import ByteLevel
    found = {}
    for b in range(256):
        text = bytes([b]).decode("latin-1")
        pieces = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(text)[0][0]
        for c, x in zip(pieces, text.encode()):
            found[c] = x
    return found


def brute(rows, libraries):
    """All facts from whole-text encodings."""
    a, b = libraries
    vocab, table = {i: t for t, i in a.get_vocab().items()}, {**token_align.byte_alphabet(), **unicode_to_byte()}
    docs, pairs = [], Counter()
    for doc_id, text in rows:
        raw = (" " + (text or "")).encode()
        ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        parts = ([bytes(table[c] for c in vocab[i]) for i in ids[0]],
                 [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]])
        if not text or any(b"".join(p) != raw for p in parts):
            docs.append((doc_id, None, []))
            continue
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i0, j0 = [], [], 0, 0
        for cut in cuts:
            i, j = ends[0].index(cut, i0), ends[1].index(cut, j0)
            groups.append(",".join(map(str, ids[0][i0:i + 1])) + "|" + ",".join(map(str, ids[1][j0:j + 1])))
            links.append((ids[0][i], ids[1][j]))
            i0, j0 = i + 1, j + 1
        pairs.update(links)
        docs.append((doc_id, (len(ids[0]), len(ids[1]), len(groups), ";".join(groups)), links))
    best = Counter()
    for (x, y), n in pairs.items():
        best[y] = max(best[y], n)
    return [(i, 0, 0, 0, 0, 0, 0, "") if f is None else
            (i, *f[:3], len(links), sum(pairs[p] == best[p[1]] for p in links), sum(pairs[p] for p in links), hashlib.sha256(f[3].encode()).hexdigest())
            for i, f, links in docs]


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


ODD = ["a  b   c", " leading and trailing  ", "tabs\tand\nlines\n\n  indented\r\n x", "Straße ñandú 世界 😀　wide\xa0space", "<|endoftext|> <s> </s> <unk> <0x0A>",
       "it's we'll I'm 123 4.5e6 !!!...", "holds ▁ itself", "\x00 nul \x1c\x85", " ", "  ", "x" * 3000, "word " * 2000, "\n", "é combining"]


def test_equals_whole_texts(spark, libraries):
    rows = [*enumerate(ODD), (100, None), (101, ""), (None, "no id"), (5, "same id"), (5, "same id")]
    df = token_align.align_documents(spark.createDataFrame(rows, "doc_id long, text string"), A_JSON, B_MODEL)
    assert result(df) == sorted(brute(rows, libraries), key=repr)


def test_real_texts_and_query(spark, sf_small, libraries):
    df = op13_token_align(spark, sf_small)
    assert df.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
                         ("groups_sha256", "string")]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert result(df) == sorted(brute(rows, libraries), key=repr)


def test_many_runs_merge_in_levels(spark, libraries):
    """A slice a partition and two runs a merge: several levels, one pair in every run."""
    rows = [(i, f"the common words and number {i % 7} of the text {'rare' * (i % 5)}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    assert result(token_align.align_documents(docs, A_JSON, B_MODEL, fan_in=2)) == sorted(brute(rows, libraries), key=repr)


def test_words_are_forgotten(libraries, monkeypatch):
    monkeypatch.setattr(token_align, "WORDS_KEPT", 50)
    aligner, texts = token_align.WordAligner(A_JSON, B_MODEL), [f"often again {i} new{i}" for i in range(300)]
    for i in range(0, 300, 20):
        facts, _, _ = aligner.documents(texts[i:i + 20])
        assert [(f[0], f[1], f[2], f[4]) for f in facts] == [(r[1], r[2], r[3], r[7]) for r in brute(list(enumerate(texts[i:i + 20])), libraries)]
    assert len(aligner.words) < 200


def test_edge_rows(spark, edge_docs, no_docs, libraries):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert result(token_align.align_documents(edge_docs, A_JSON, B_MODEL)) == sorted(brute(rows, libraries), key=repr)
    assert token_align.align_documents(no_docs, A_JSON, B_MODEL).count() == 0
