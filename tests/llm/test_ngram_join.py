"""N-gram join against all pairs."""

import random

import pytest

from trialframe.llm import ngram_join, queries


def shingle_sets(texts, words):
    out = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[k:k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])
    return out


def brute(texts, words, percent):
    sets = shingle_sets(texts, words)
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def joined(docs, words, percent):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_components(docs, words, percent).collect()}


def edited(r, words, share, vocabulary):
    out = list(words)
    for _ in range(int(share * len(words))):
        out[r.randrange(len(out))] = r.choice(vocabulary)
    return out


def corpus(seed, groups=12, copies=9):
    """Chains of edited copies, shared passages, exact copies, short and empty texts."""
    r = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(400)]
    passage = r.choices(vocabulary, k=40)
    texts = []
    for g in range(groups):
        base = r.choices(vocabulary, k=r.choice([3, 12, 60, 200]))
        for _ in range(copies):
            texts.append(" ".join(base))
            base = edited(r, base, r.choice([0, 0.005, 0.02, 0.05]), vocabulary)
    texts += [" ".join(r.choices(vocabulary, k=r.randint(0, 30)) + passage) for _ in range(40)]
    texts += ["", " ", "a", "A", "a b", "a b c", "A B\tc", None]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("words", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (1, 80, 3), (2, 60, 4), (3, 100, 5)])
def test_against_all_pairs(spark, words, percent, seed):
    texts = corpus(seed)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = brute(texts, words, percent)
    assert joined(docs, words, percent) == want
    assert len({c for _, c in want.values()}) < len(want)


def test_frequent_tokens_use_combinations(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "RARE", 2)
    texts = corpus(6, groups=4, copies=25)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert joined(docs, 3, 90) == brute(texts, 3, 90)


def test_rounds_of_centres(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "ALL_PAIRS", 0)      # centres until they no longer halve what is left
    texts = corpus(7, groups=3, copies=30)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert joined(docs, 3, 80) == brute(texts, 3, 80)


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    texts = corpus(8, groups=5)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert joined(docs, 3, 90) == brute(texts, 3, 90)


def test_prefix_bounds_hold():
    for percent in (60, 80, 90, 97, 100):
        b = ngram_join.Bounds(percent)
        for n in range(1, 400):
            for m in range(n, b.most(n) + 1):
                common = -(-percent * (n + m) // (100 + percent))       # the least overlap of similar sets
                if common > n:
                    continue
                assert common >= n - b.lacking(n) and common >= m - b.lacking(m)
                assert min(b.ext(n), b.ext(m)) >= max(b.shared(n), b.shared(m))
                level = m.bit_length() - 1
                assert level in {n.bit_length() - 1, b.most(n).bit_length() - 1}
                assert b.classes(level) <= min(b.shared(n), b.shared(m)) - 1


def test_edges(spark, edge_docs, no_docs):
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.join_components(edge_docs, 3, 90).collect()), key=str)
    assert got == sorted([(None, None), (1, 1), (2, 2), (3, 3), (4, 3), (4, 3), (5, 3), (6, 6), (7, 7), (8, 8)], key=str)
    kept = ngram_join.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([None, 1, 2, 3, 6, 7, 8], key=str)
    assert ngram_join.join_components(no_docs, 3, 90).count() == 0


def test_op4_against_all_pairs(spark, sf_small):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    rows = queries.op4_ngram_jaccard(spark, sf_small).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts, 3, 90)
