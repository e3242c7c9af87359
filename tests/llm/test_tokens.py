"""Merge replay and token files against the tokenizer libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trialframe.llm import bpe, queries, token_store
from trialframe.llm.common import map_batches

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
SIGNS = "aaabbcdeé ñ  \n\n\t1234!!..'s'll 世界😀 　\x1c\x1f\x85"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def json_library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


def random_texts(n, seed=3):
    r = random.Random(seed)
    texts = ["".join(r.choice(SIGNS) for _ in range(r.randint(0, 60))) for _ in range(n)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    return texts + ["".join(r.choice(letters) for _ in range(r.randint(1, 40))) for _ in range(n)] + ["a" * k for k in range(120)]


def test_replay_equals_library(library):
    texts = random_texts(2_000)
    encoder = bpe.CorpusEncoder(bpe.load_ranks(RANKS), P.PATTERN)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
        assert encoder.replay.decode(ids).decode() == text


def test_replay_when_a_merge_opens_a_lower_rank():
    # "abc" (rank 256) can only arise after "ab" (257): the new pair is of lower rank than the one just merged
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"abab": 258}
    replay = bpe.MergeReplay(ranks)
    words = [b"abcab", b"ababab", b"abababc", b"cabab", b"a", b"abcabcab"]
    ids, counts = replay.encode_words(words)
    for word, part in zip(words, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert part.tolist() == replay.one_word(word)


def test_words_are_forgotten_without_effect(library, monkeypatch):
    monkeypatch.setattr(bpe, "VOCABULARY_KEPT", 5)
    encoder = bpe.CorpusEncoder(bpe.load_ranks(RANKS), P.PATTERN)
    for text in random_texts(30):
        assert next(encoder.encode([text])).tolist() == library.encode_ordinary(text)


def test_query_on_edges(spark, edge_docs, no_docs, library):
    encoded = bpe.encode_documents(edge_docs, RANKS, P.PATTERN)
    got = sorted((r.doc_id or -1, r.n_tokens, bytes(r.decoded).decode())
                 for r in bpe.decode_documents(encoded, RANKS, "n_tokens").collect())
    assert got == sorted((r.doc_id or -1, len(library.encode_ordinary(r.text or "")), r.text or "") for r in edge_docs.collect())
    assert bpe.encode_documents(no_docs, RANKS, P.PATTERN).count() == 0


def test_op1_against_library(spark, sf_small, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = queries.op1_bpe_roundtrip(spark, sf_small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = np.array(library.encode_ordinary(docs[r.doc_id]), dtype="<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_runs_equal_whole_texts(json_library):
    texts = random_texts(2_000) + ["a <|endoftext|>b<|endoftext|>", "<|endoftext", "|>x"]
    encoder = token_store.RunEncoder(JSON)
    assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in json_library.encode_batch(texts, add_special_tokens=False)]
    encoder = token_store.RunEncoder(JSON)
    encoder.fence = None
    assert [x.tolist() for x in encoder.encode(texts[:50])] == [json_library.encode(t, add_special_tokens=False).ids for t in texts[:50]]


def test_numbers_stay_dense_however_much_was_seen():
    numbering = bpe.Numbering(["b"])
    for _ in range(3):
        assert numbering.numbers_of(["a", "b", "a", "c"]).tolist() == [1, 0, 1, 2]
    assert numbering.since(0) == ["b", "a", "c"] and numbering.numbers_of(["d"]).tolist() == [3]


def test_workers_get_bounded_batches(spark):
    docs = spark.range(0, 3_000, 1, 1).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))

    def make():
        def step(batch):
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])
        return step

    sizes = [r.n for r in map_batches(docs, make, "n long").collect()]
    assert sum(sizes) > 30_000_000 and max(sizes) < 5 << 20


def test_op7_against_library(spark, sf_small, json_library):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect())
    got = {r.doc_id: r for r in queries.op7_token_store(spark, sf_small).collect()}
    start = 0
    for doc_id, text in docs:
        ids = np.array([*json_library.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        r = got.pop(doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_token_files(spark, edge_docs, no_docs, tmpdir_path, json_library, monkeypatch):
    monkeypatch.setattr(token_store, "SEGMENT_DOCS", 2)
    path = token_store.write_tokens(edge_docs, f"{tmpdir_path}/edges", JSON)
    rows = token_store.read_tokens(spark, path).collect()
    assert len(rows) == edge_docs.count()
    ordered = sorted(rows, key=lambda r: r.start)
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1].tolist()
    want = sorted([*json_library.encode(r.text or "", add_special_tokens=False).ids, 2] for r in edge_docs.collect())
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in rows) == want
    one = token_store.read_document(spark, path, 8).collect()
    assert [(r.doc_id, r.start) for r in one] == [(r.doc_id, r.start) for r in rows if r.doc_id == 8]
    assert len(token_store.read_document(spark, path, 4).collect()) == 2
    none = token_store.write_tokens(no_docs, f"{tmpdir_path}/none", JSON)
    assert token_store.read_tokens(spark, none).count() == 0


def test_a_wrong_dictionary_is_noticed(spark, edge_docs, tmpdir_path):
    path = token_store.write_tokens(edge_docs, f"{tmpdir_path}/dict", JSON)
    meta = spark.read.parquet(f"{path}/dictionary").first()
    assert token_store.dictionary_hash(bytes(meta.dictionary)) == meta.dict_hash
    other = spark.createDataFrame([("0" * 32, bytes(meta.dictionary), meta.id_bytes, meta.end_id)],
                                  "dict_hash string, dictionary binary, id_bytes int, end_id long")
    other.write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError, match="hash"):
        token_store.read_tokens(spark, path)


def test_led_runs_are_encoded_side_by_side(monkeypatch):
    encoder, library = token_store.RunEncoder(JSON), Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    texts = ["one two  three", " one\ttwo!", "\u3000wide  naïve 😀 \x85", "", "a</s> b", "\n\nlast\n", " x" * 30_000]
    kinds, joined = [], encoder.joined
    monkeypatch.setattr(encoder, "joined", lambda runs: kinds.append(len(runs)) or joined(runs))
    got = [x.tolist() for x in encoder.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = [x.tolist() for x in encoder.encode(texts[:3] + [" more words \u2028here"])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in [*texts[:3], " more words \u2028here"]]
    assert sum(kinds) >= 3
    encoder.lengths = encoder.lengths + 1      # bytes that do not fit: the runs are fenced instead
    assert encoder.joined([" two", " six"]) is None
    assert [x.tolist() for x in encoder.encode([" seven eight"])] == [library.encode(" seven eight", add_special_tokens=False).ids]


def test_a_worker_keeps_no_freed_memory(spark):
    """Small blocks freed under a living one: malloc holds them until they are given back."""
    def make():
        import os
        import sys

        def anonymous():
            with open("/proc/self/smaps_rollup") as f:
                return sum(int(line.split()[1]) for line in f if line.startswith("Pss_Anon"))

        before = anonymous()

        def step(batch):
            blocks = [os.urandom(2000) for _ in range(100_000)]
            sys.pinned = [*getattr(sys, "pinned", ()), os.urandom(2000)]        # above the blocks
            yield pa.RecordBatch.from_arrays([pa.array([len(blocks)]), pa.array([before]), pa.array([os.getpid()])], names=["n", "kb", "pid"])
        return step

    rows = spark.range(1).coalesce(1)
    kept = [map_batches(rows, make, "n long, kb long, pid long").collect()[0] for _ in range(4)]
    by_worker: dict[int, list[int]] = {}
    for r in kept:
        by_worker.setdefault(r.pid, []).append(r.kb)
    again = [after[0] - before for before, *after in by_worker.values() if after]
    assert again and max(again) < 100_000
