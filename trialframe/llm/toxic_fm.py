"""Toxicity: a factorization machine over hashed terms.

A document is the set of its hashed terms: each word, and the beginnings of ``PREFIXES``
letters of longer words.  The machine gives each term a weight and a vector; the vectors'
products weigh every pair of terms, so a pair (an insult with a mention of a group) counts
where neither term does alone:

    logit = w0 + sum_i w_i + 1/2 * sum_f ((sum_i v_if)^2 - sum_i v_if^2)

``fit`` learns it by AdaGrad with soft thresholds in numpy on at most ``SAMPLE_PER_CLASS`` labelled documents of each
class of at most ``SAMPLE_BYTES`` bytes (bounds are parameters), chosen by a hash of the id.
Terms seen in fewer than ``MIN_DOCS`` of them stay at 0; all others are learned, and only the soft
thresholds make terms without effect 0.  The weights are learned alone for ``ALONE`` rounds, then the
vectors with them: so pairs explain what single terms leave, and do not learn by heart what these can tell.  A vector's
steps shrink with its slopes (``FLOOR``).  The schedule was chosen on a quarter of the learning fold, not on held-out rows.
The class shares of all labelled
documents, counted in full, correct the sample's balance.  The model has ``BUCKETS`` rows
whatever the corpus, and scoring needs no shuffle.

Defined cases: null text = empty text: no terms, the score is that of w0; null labels are
not used; labels of one class only, or none, give their share (0.5 for none); repeated
rows get equal scores; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialframe.llm.byte_cnn import sample_labelled
from trialframe.llm.common import id_text, map_batches, slices

BITS, FACTORS = 18, 6
BUCKETS = 1 << BITS
PREFIXES = (4, 5)
SAMPLE_PER_CLASS, SAMPLE_BYTES = 4_000, 20_000
MIN_DOCS = 3
START = 0.3             # spread of the vectors at their start, over the root of the mean number of terms
ALONE = 4               # rounds of the weights without the vectors
FLOOR = 1.0             # added to the root of a vector's squared slopes: slopes that are nearly 0 must not become full steps
RATE_ALL = 1.0          # of w0, faster than terms of all documents would take its place
EPOCHS, RATE, SPARSE, SPARSE_PAIRS, DOCS_A_STEP = 8, 0.1, 1e-3, 1e-4, 64
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall


class TermBook(dict):
    """word -> number; ``table`` holds its hashed terms, row by row; forgotten from time to time."""

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.rows: list[tuple[int, ...]] = []

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace")
        terms = [b"w" + word, *(b"p" + text[:n].encode() for n in PREFIXES)]
        self.rows.append(tuple(xxhash.xxh3_64_intdigest(t) & (BUCKETS - 1) for t in terms))
        n = self[word] = len(self)
        return n


class Terms:
    """Distinct hashed terms of texts."""

    def __init__(self):
        self.book = TermBook()
        self.table = np.zeros((0, 1 + len(PREFIXES)), dtype=np.int32)

    def of(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.book) > 500_000:
            self.book.reset()
            self.table = self.table[:0]
        words = [WORDS(t.encode().lower()) for t in texts]
        codes = [np.fromiter(map(self.book.__getitem__, w), dtype=np.int32, count=len(w)) for w in words]
        if len(self.book.rows) > len(self.table):
            fresh = np.array(self.book.rows[len(self.table):], dtype=np.int32)
            self.table = np.concatenate([self.table, fresh])
        for c in codes:
            yield np.unique(self.table[np.unique(c)])


def terms_table(rows: DataFrame, *more: str) -> DataFrame:
    """(``more``..., terms array<int>) of rows with ``text``."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (rows.schema[c] for c in more))

    def make():
        terms = Terms()

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                got = [x.tolist() for x in terms.of(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in more), pa.array(got, pa.list_(pa.int32()))],
                                                 names=[*more, "terms"])
        return step

    return map_batches(rows.select("text", *more), make, f"{kinds}, terms array<int>")


def train(docs: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> dict[str, np.ndarray]:
    """w0, w (BUCKETS) and v (BUCKETS, FACTORS): ``ALONE`` rounds of the weights, then of both, 2 * ``epochs`` in all."""
    used = np.flatnonzero(np.bincount(np.concatenate(docs), minlength=BUCKETS) >= MIN_DOCS)
    row = np.full(BUCKETS, -1, dtype=np.int32)
    row[used] = np.arange(len(used))
    sets = [r[r >= 0] for r in (row[d] for d in docs)]
    r = np.random.default_rng(seed)
    w = np.zeros((len(used), 1 + FACTORS), dtype=np.float32)      # weight and vector
    start = r.normal(size=(len(used), FACTORS)) * START / np.sqrt(max(1.0, np.mean([len(x) for x in sets])))
    w0 = np.float32(0)
    squared = np.zeros_like(w)
    floor = np.array([1e-3, *[FLOOR] * FACTORS], dtype=np.float32)
    for epoch in range(2 * epochs):
        if epoch == ALONE:
            w[:, 1:] = start            # vectors of 0 do not move
        turn = r.permutation(len(sets))
        for at in range(0, len(turn), DOCS_A_STEP):
            part = [sets[d] for d in turn[at: at + DOCS_A_STEP]]
            sizes = np.array([len(x) for x in part])
            owner, ids = np.repeat(np.arange(len(part)), sizes), np.concatenate(part)
            x = w[ids]
            total = np.stack([np.bincount(owner, weights=x[:, k], minlength=len(part)) for k in range(1 + FACTORS)], axis=1).astype(np.float32)
            squares = np.bincount(owner, weights=(x[:, 1:] ** 2).sum(axis=1), minlength=len(part))
            z = w0 + total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[turn[at: at + DOCS_A_STEP]]).astype(np.float32) / len(part)
            g = np.empty_like(x)
            g[:, 0] = error[owner]
            g[:, 1:] = error[owner, None] * (total[owner, 1:] - x[:, 1:])
            rows, back = np.unique(ids, return_inverse=True)
            grad = np.stack([np.bincount(back, weights=g[:, k], minlength=len(rows)) for k in range(1 + FACTORS)], axis=1).astype(np.float32)
            squared[rows] += grad ** 2
            step = RATE / (np.sqrt(squared[rows]) + floor)
            moved = w[rows] - step * grad
            # soft thresholds (weights one by one, vectors by their length) keep terms without effect at 0
            moved[:, 0] = np.sign(moved[:, 0]) * np.maximum(np.abs(moved[:, 0]) - step[:, 0] * SPARSE, 0)
            norm = np.sqrt((moved[:, 1:] ** 2).sum(axis=1, keepdims=True))
            moved[:, 1:] *= np.maximum(1 - step[:, 1:].mean(axis=1, keepdims=True) * SPARSE_PAIRS / np.maximum(norm, 1e-9), 0)
            w[rows] = moved
            w0 -= RATE_ALL * error.sum()
    full = np.zeros((BUCKETS, 1 + FACTORS), dtype=np.float32)
    full[used] = w
    return {"w0": float(w0), "w": full}


def logit(model: dict, terms: np.ndarray) -> float:
    x = model["w"][terms]
    total = x.sum(axis=0)
    return float(model["w0"] + total[0] + 0.5 * ((total[1:] ** 2).sum() - (x[:, 1:] ** 2).sum()))


def fit(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column,
        per_class: int = SAMPLE_PER_CLASS, max_bytes: int = SAMPLE_BYTES) -> dict:
    rows, counts = sample_labelled(docs, labels, label, may_learn, per_class, max_bytes)
    got = sorted(((r.doc_id, r.label, r.terms) for r in terms_table(rows, "doc_id", "label").collect()), key=lambda r: r[:2])
    y = np.array([r[1] for r in got], dtype=np.float32)
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if not n0 or not n1 or not 0 < y.sum() < len(y):
        return {"w": None, "shift": 0.5 if n0 + n1 == 0 else n1 / (n0 + n1)}
    share = float(y.mean())
    model = train([np.array(r[2], dtype=np.int32) for r in got], y)
    return model | {"shift": float(np.log(n1 / n0) - np.log(share / (1 - share)))}


def score(docs: DataFrame, model: dict, *more: str) -> DataFrame:
    """(doc_id, ``more``..., score double): the probability of label 1 for each whole text."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (docs.schema[c] for c in ("doc_id", *more)))
    shared = docs.sparkSession.sparkContext.broadcast(model)     # BUCKETS rows whatever the corpus

    def make():
        terms, held = Terms(), shared.value

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                if held["w"] is None:
                    z = [float(held["shift"])] * part.num_rows
                else:
                    z = [float(1 / (1 + np.exp(-np.clip(logit(held, t) + held["shift"], -30, 30))))
                         for t in terms.of(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", *more)), pa.array(z, pa.float64())],
                                                 names=["doc_id", *more, "score"])
        return step

    return map_batches(id_text(docs, *more), make, f"{kinds}, score double")
