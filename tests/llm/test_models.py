"""Language model, quality network and factorization machine."""

import collections
import contextlib
import io
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trialframe.llm import brown_lm, byte_cnn, queries, toxic_fm
from trialframe.llm.common import fold_is


def tokens_of(text):
    return [*(text or "").encode().lower().split(), None]


def check_base(rows, docs, held):
    counts = collections.Counter()
    for i, t in docs:
        if not held(i):
            counts.update(tokens_of(t))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in docs:
        w = tokens_of(t)
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
        want.append((i, held(i), len(w), sum(counts[x] > 0 for x in w), total, base))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows]
    for g, w in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)


def test_op5_base_and_gain(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    rows = queries.op5_brown_lm(spark, sf_small).collect()
    check_base(rows, docs, lambda i: zlib.crc32(str(i).encode()) % 5 == 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_blocks_and_buckets_change_nothing(spark, sf_small, monkeypatch):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(60)
    one = {r.doc_id: r for r in brown_lm.score_documents(docs, fold_is("doc_id", 1)).collect()}
    monkeypatch.setattr(brown_lm, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(brown_lm, "KEPT", 500)
    for r in brown_lm.score_documents(docs, fold_is("doc_id", 1)).collect():
        assert r.score == pytest.approx(one[r.doc_id].score, rel=1e-9) and r.n_known == one[r.doc_id].n_known


def test_lm_shuffles_no_texts(spark, sf_small, monkeypatch):
    plans, write = {}, brown_lm.shared_table

    def seen(df, name, **options):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            df.explain()
        plans[name] = out.getvalue()
        return write(df, name, **options)
    monkeypatch.setattr(brown_lm, "shared_table", seen)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(20)
    brown_lm.score_documents(docs.localCheckpoint(), fold_is("doc_id", 1))
    assert plans and all("Exchange" not in plan or "text#" not in plan for plan in plans.values())


def test_packed_numbers():
    for numbers in (np.zeros(0, dtype=np.int64), np.array([0, 255, 256, 70_000, 2**32 - 1])):
        assert brown_lm.unpacked(brown_lm.packed(numbers)).tolist() == numbers.tolist()


def brute_scores(docs, held, core_size):
    """The class model by dictionaries; words with equal evidence for several classes go to the first."""
    learn = [tokens_of(t) for i, t in docs if not held(i)]
    counts = collections.Counter(w for t in learn for w in t)
    signed = lambda w: int(np.uint64(xxhash.xxh3_64_intdigest(w)).view(np.int64))       # noqa: E731
    core = sorted((w for w in counts if w is not None), key=lambda w: (-counts[w], signed(w)))[:core_size]
    number = {**{w: k for k, w in enumerate(core)}, None: len(core)}
    follow = np.zeros((len(core) + 1,) * 2)
    for t in learn:
        met = [None, *[w for w in t if w in number]]
        for a, b in zip(met[:-1], met[1:], strict=True):
            follow[number[a], number[b]] += 1
    cls = brown_lm.exchange(follow)
    pair = np.eye(brown_lm.ALL)[cls].T @ follow @ np.eye(brown_lm.ALL)[cls] + brown_lm.ADD
    lift = np.log(pair / pair.sum(axis=1, keepdims=True)) - np.log(pair.sum(axis=0) / pair.sum())
    seen = collections.defaultdict(lambda: np.zeros(brown_lm.ALL))
    for t in learn:
        ctx = brown_lm.END_CLASS
        for w in t:
            seen[w][ctx] += 1
            ctx = cls[number[w]] if w in number else ctx
    of = {w: int(cls[number[w]]) if w in number else int(np.argmax((seen[w] @ lift)[:brown_lm.CLASSES])) for w in counts}
    of[None] = brown_lm.END_CLASS
    moves, size, kinds = collections.Counter(), collections.Counter(), collections.Counter(of[w] for w in counts)
    for t in learn:
        for a, b in zip([None, *t[:-1]], t, strict=True):
            moves[of[a], of[b]] += 1
            size[of[b]] += 1
    total, out = sum(counts.values()), {}
    row = [sum(moves[a, b] for b in range(brown_lm.ALL)) for a in range(brown_lm.ALL)]
    move = lambda a, b: (moves[a, b] + 0.5) / (row[a] + 0.5 * brown_lm.ALL)      # noqa: E731
    mass = [size[k] + 0.5 * (kinds[k] + 1) for k in range(brown_lm.ALL)]
    for i, t in docs:
        ctx, score = brown_lm.END_CLASS, 0.0
        for w in tokens_of(t):
            base = (counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))
            if counts[w]:
                own = move(ctx, of[w]) * (counts[w] + 0.5) / mass[of[w]]
            else:
                own = sum(move(ctx, k) * 0.5 / mass[k] for k in range(brown_lm.ALL))
            score += math.log10(0.9 * own + 0.1 * base)
            ctx = of[w] if counts[w] else ctx
        out[i] = score
    return out


def test_scores_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(brown_lm, "CORE", 20)
    monkeypatch.setattr(brown_lm, "BLOCK_BYTES", 2_000)
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(80)]
    docs = [(i, " ".join(r.choices(vocabulary, [1 / (k + 1) for k in range(80)], k=r.randint(0, 60)))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "never seen w1 w2 unseen W1"), (203, "w3 " * 3000)]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1 or i == 202            # noqa: E731
    want = brute_scores(docs, held, 20)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = brown_lm.score_documents(frame, fold_is("doc_id", 1) | (F.col("doc_id") == 202)).collect()
    assert len(rows) == len(docs)
    for row in rows:
        assert row.score == pytest.approx(want[row.doc_id], rel=1e-9), row.doc_id


def test_lm_on_edges(spark, edge_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    rows = brown_lm.score_documents(edge_docs, F.lit(False)).collect()
    check_base(rows, docs, lambda i: False)
    nothing = brown_lm.score_documents(edge_docs, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in nothing)
    assert brown_lm.score_documents(no_docs, F.lit(False)).count() == 0


def test_probabilities_sum_to_one():
    r = np.random.default_rng(1)
    n = r.integers(1, 50, size=200)
    cls = r.integers(0, brown_lm.CLASSES, size=200)
    moves = r.integers(0, 9, size=(brown_lm.ALL, brown_lm.ALL))
    model = brown_lm.Model(np.concatenate([moves.ravel(), np.bincount(cls, weights=n, minlength=brown_lm.ALL),
                                           np.bincount(cls, minlength=brown_lm.ALL)]))
    for ctx in (0, 5, brown_lm.END_CLASS):
        known = model.probability(n.astype(float), cls, np.full(200, ctx)).sum()
        unseen = model.probability(np.zeros(1), np.zeros(1, dtype=int), np.array([ctx]))[0]
        assert known + unseen == pytest.approx(1, abs=1e-9)


def likelihood(follow, cls):
    one = np.eye(brown_lm.ALL)[cls]
    pair = one.T @ follow @ one
    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()      # noqa: E731
    return f(pair) - f(pair.sum(axis=1)) - f(pair.sum(axis=0))


def test_exchange_reaches_a_local_optimum():
    r = np.random.default_rng(2)
    kinds = r.integers(0, 4, size=60)                       # words of four kinds that follow each other in a circle
    follow = r.poisson(0.2, size=(61, 61)) + 30 * (np.append(kinds, 9)[:, None] + 1 == np.append(kinds, 8)[None, :]) * r.poisson(1, size=(61, 61))
    follow = follow.astype(float)
    cls = brown_lm.exchange(follow)
    start = np.append(np.arange(60) % brown_lm.CLASSES, brown_lm.END_CLASS)
    best = likelihood(follow, cls)
    assert best > likelihood(follow, start) and cls[-1] == brown_lm.END_CLASS
    for w in range(0, 60, 7):
        for k in range(0, brown_lm.CLASSES, 5):
            moved = cls.copy()
            moved[w] = k
            assert likelihood(follow, moved) <= best + 1e-6


def test_chunks_cover_everything():
    for n in (0, 1, byte_cnn.OVERLAP, byte_cnn.CHUNK, byte_cnn.CHUNK + 1, 10_000):
        data = bytes(i % 251 for i in range(n))
        cut = byte_cnn.chunks_of(data)
        step = byte_cnn.CHUNK - byte_cnn.OVERLAP
        flat = np.concatenate([cut[:-1, :step].ravel(), cut[-1]])
        assert bytes(flat[:n].astype(np.uint8)) == data and (flat[n:] == byte_cnn.PAD).all()


def test_network_learns():
    texts = [b"good words stand here", b"BAD!! BAD!! $$$ junk"] * 3
    y = np.array([1, 0] * 3, dtype=np.float32)
    w = byte_cnn.train(texts, y, steps=60)
    z = [byte_cnn.logit(w, t) for t in texts[:2]]
    assert z[0] > 1 > -1 > z[1]


def test_network_gradient():
    r = np.random.default_rng(4)
    texts = [bytes(r.integers(32, 127, size=n).astype(np.uint8)) for n in (0, 40, byte_cnn.CHUNK + 30, 3 * byte_cnn.CHUNK)]
    y = np.array([1, 0, 1, 0], dtype=np.float64)
    w = {k: v.astype(np.float64) + 0.05 * r.normal(size=v.shape) for k, v in byte_cnn.new_weights(3).items()}
    cut = [byte_cnn.chunks_of(t) for t in texts]
    g = byte_cnn.slopes(w, np.concatenate(cut), np.array([len(c) for c in cut]), y)

    def loss():
        p = 1 / (1 + np.exp(-np.array([byte_cnn.logit(w, t) for t in texts])))
        decay = 0.5 * byte_cnn.DECAY * ((w["out"] ** 2).sum() + (w["filters"] ** 2).sum())
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) + decay

    told = 0
    for k in w:
        steep = np.argsort(-np.abs(g[k].ravel()))[:5]           # the steepest, and some others
        for i in {*steep.tolist(), *r.integers(0, w[k].size, size=5).tolist()}:
            flat, kept = w[k].reshape(-1), w[k].flat[i]
            flat[i] = kept + 1e-6
            high = loss()
            flat[i] = kept - 1e-6
            low = loss()
            flat[i] = kept
            assert g[k].flat[i] == pytest.approx((high - low) / 2e-6, rel=2e-3, abs=2e-7), (k, i)
            told += abs(g[k].flat[i]) > 1e-6
    assert told > 15


def test_network_sees_the_end_of_long_texts():
    good = b"plain words in a row and more of them " * 30
    texts = [good[: 200 + 50 * i] for i in range(10)] + [good[: 200 + 50 * i] + b" $$$ ### $$$ ### $$$" for i in range(10)]
    w = byte_cnn.train(texts, np.array([1] * 10 + [0] * 10, dtype=np.float32), steps=80)
    long = good * 40
    assert byte_cnn.logit(w, long) > byte_cnn.logit(w, long + b" $$$ ### $$$ ### $$$")


def auc(y, s):
    y, s = np.array(y), np.array(s)
    return np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])


@pytest.mark.parametrize(("query", "label", "least"), [("op9_byte_cnn", "quality", 0.9), ("op10_factor_toxic", "toxic", 0.8)])
def test_held_out_accuracy(spark, query, label, least):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.QUERIES[query](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count() and all(0 <= r.score <= 1 for r in rows)
    held = [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    assert auc(*zip(*held, strict=True)) > least


def test_machine_learns_pairs():
    r = np.random.default_rng(4)
    filler = [f"f{i}" for i in range(60)]
    texts, y = [], []
    for _ in range(1_200):                                  # toxic only where both words stand
        a, b = r.random(2) < 0.5
        texts.append(" ".join([*r.choice(filler, 8), *["insult"] * int(a), *["group"] * int(b)]))
        y.append(int(a and b))
    terms = list(toxic_fm.Terms().of(texts))
    model = toxic_fm.train(terms, np.array(y, dtype=np.float32), epochs=30)
    both, one, other, none = (toxic_fm.logit(model, t) for t in toxic_fm.Terms().of(
        ["f1 f2 insult group", "f1 f2 insult", "f1 f2 group", "f1 f2"]))
    assert both > 0 > max(one, other, none)
    assert (np.abs(model["w"][:, 1:]).sum(axis=1) > 0).any()


def test_machine_learns_exclusive_or_in_longer_texts():
    r = np.random.default_rng(12)
    filler = [f"{i}f{i}" for i in range(400)]
    texts, y = [], []
    for _ in range(4_000):
        a, b = r.random(2) < 0.5
        texts.append(" ".join([*r.choice(filler, 40), *["insult"] * int(a), *["group"] * int(b)]))
        y.append(int(a != b))
    terms = list(toxic_fm.Terms().of(texts))
    model = toxic_fm.train(terms[:3_000], np.array(y[:3_000], dtype=np.float32))
    assert auc(y[3_000:], [toxic_fm.logit(model, t) for t in terms[3_000:]]) > 0.9


def test_vectors_count_on_given_labels():
    """On the learning fold of sf0.1: vectors are not 0, and without them documents get other scores."""
    import zlib
    import pyarrow.parquet as pq
    base = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{base}/labels.parquet").to_pylist() if r["toxic"] is not None}
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{base}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
            if r["doc_id"] in toxic and r["text"] and len(r["text"].encode()) <= toxic_fm.SAMPLE_BYTES]
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in rows]
    terms = list(toxic_fm.Terms().of([t for _, t in rows]))
    y = np.array([toxic[i] for i, _ in rows], dtype=np.float32)
    learn = [k for k, h in enumerate(held) if not h]
    model = toxic_fm.train([terms[k] for k in learn], y[learn])
    assert (np.abs(model["w"][:, 1:]).sum(axis=1) > 0).sum() > 1_000
    flat = model["w"].copy()
    flat[:, 1:] = 0
    out = [k for k, h in enumerate(held) if h]
    with_vectors = np.array([toxic_fm.logit(model, terms[k]) for k in out])
    without = np.array([toxic_fm.logit({"w0": model["w0"], "w": flat}, terms[k]) for k in out])
    assert np.abs(with_vectors - without).mean() > 0.05
    assert auc([int(y[k]) for k in out], with_vectors.tolist()) > 0.97


def test_machine_learns_exclusive_or():
    r = np.random.default_rng(9)
    filler = [f"{i}f{i}" for i in range(60)]
    texts, y = [], []
    for _ in range(2_500):                                  # each word alone is equally common in both classes
        a, b = r.random(2) < 0.5
        texts.append(" ".join([*r.choice(filler, 8), *["insult"] * int(a), *["group"] * int(b)]))
        y.append(int(a != b))
    terms = list(toxic_fm.Terms().of(texts))
    model = toxic_fm.train(terms[:2_000], np.array(y[:2_000], dtype=np.float32))
    assert auc(y[2_000:], [toxic_fm.logit(model, t) for t in terms[2_000:]]) > 0.95


def test_rare_terms_are_learned():
    r = np.random.default_rng(3)
    filler = [f"{i}f{i}" for i in range(60)]
    texts = [" ".join([*r.choice(filler, 8), *["zzyq"] * int(i < 6)]) for i in range(800)]       # 6 of 400 toxic documents
    model = toxic_fm.train(list(toxic_fm.Terms().of(texts)), np.array([1] * 400 + [0] * 400, dtype=np.float32))
    told, plain = (toxic_fm.logit(model, t) for t in toxic_fm.Terms().of(["zzyq", ""]))
    assert told > plain


@pytest.mark.parametrize("module", [byte_cnn, toxic_fm])
def test_classifiers_on_edges(spark, edge_docs, no_docs, module):
    few = spark.createDataFrame([(3, 1, "x"), (4, 0, "x"), (4, 0, "x"), (5, None, "x"), (None, 1, "x"), (99, 1, "x"), (8, 1, "x")],
                                "doc_id long, quality int, text string")
    model = module.fit(edge_docs, few, "quality", F.lit(True), max_bytes=1 << 20)
    rows = module.score(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 4}) == 1
    for labels, share in ((few.where("false"), 0.5), (few.where("quality = 1"), 1.0)):
        model = module.fit(edge_docs, labels, "quality", F.lit(True))
        assert {r.score for r in module.score(edge_docs, model).collect()} == {share}
    assert module.score(no_docs, module.fit(no_docs, few, "quality", F.lit(True))).count() == 0
