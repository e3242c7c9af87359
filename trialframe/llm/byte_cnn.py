"""Quality classifier: a byte-level convolutional network in numpy.

``fit(docs, labels, label, ...)`` trains a small network, ``score(docs, model)`` gives
every document one probability.

The network cuts a text's UTF-8 bytes into chunks of ``CHUNK`` bytes that overlap by
``OVERLAP`` and cover the whole document.  Learned filters of ``WIDTH`` bytes over learned
byte embeddings run along each chunk; each filter is max-pooled within its chunk.
The document's features are each filter's maximum and mean over the chunks, and a
logistic layer makes one probability of them.

Training sees at most ``SAMPLE_PER_CLASS`` labelled documents of each class, of at most
``SAMPLE_BYTES`` bytes each, chosen by a hash of the id (bounds are parameters).  The
classes take equal parts in it; their shares among all labelled documents, counted in full,
set the level of the probabilities.
Scoring is a per-batch numpy function without a shuffle, so memory is bounded by the
chunks of one text at a time and a lost task is simply run again.

Defined cases: null text = empty text: one chunk of padding, so it gets a score; null
labels are not used; labels of one class only, or none, give their share (0.5 for none)
as every score; repeated rows get equal scores; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialframe.llm.common import id_text, map_batches, slices

CHUNK, OVERLAP, WIDTH, STRIDE = 512, 64, 8, 2
DIMENSIONS, FILTERS = 8, 24
SAMPLE_PER_CLASS, SAMPLE_BYTES = 1_000, 12_000
STEPS, RATE, DECAY, DOCS_A_STEP = 500, 0.01, 1e-4, 32
PAD = 256


def chunks_of(data: bytes) -> np.ndarray:
    """(chunks, CHUNK) byte ids, padded; consecutive chunks share OVERLAP bytes."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(data) - OVERLAP) // step))
    flat = np.full(n * step + OVERLAP, PAD, dtype=np.int16)
    flat[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::step]


def new_weights(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    return {"bytes": (r.normal(size=(257, DIMENSIONS)) * 0.5).astype(np.float32),
            "filters": (r.normal(size=(WIDTH * DIMENSIONS, FILTERS)) / np.sqrt(WIDTH * DIMENSIONS)).astype(np.float32),
            "bias": np.zeros(FILTERS, dtype=np.float32),
            "out": (r.normal(size=2 * FILTERS) * 0.1).astype(np.float32), "base": np.zeros(1, dtype=np.float32)}


def windows(embedded: np.ndarray) -> np.ndarray:
    """(chunks, places, WIDTH * DIMENSIONS) of embedded chunks (chunks, CHUNK, DIMENSIONS)."""
    view = np.lib.stride_tricks.sliding_window_view(embedded.reshape(len(embedded), -1), WIDTH * DIMENSIONS, axis=1)
    return view[:, :: STRIDE * DIMENSIONS]


def activations(w: dict, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per chunk: each filter's maximum, where it stands, and the windows."""
    win = np.ascontiguousarray(windows(w["bytes"][chunks]))
    out = (win.reshape(-1, WIDTH * DIMENSIONS) @ w["filters"]).reshape(len(chunks), win.shape[1], FILTERS)
    where = out.argmax(axis=1)
    best = np.take_along_axis(out, where[:, None], axis=1)[:, 0] + w["bias"]
    return np.maximum(best, 0), where, win


def pooled(w: dict, chunks: np.ndarray) -> np.ndarray:
    """Per chunk maxima only, for scoring."""
    win = np.ascontiguousarray(windows(w["bytes"][chunks]))
    out = (win.reshape(-1, WIDTH * DIMENSIONS) @ w["filters"]).reshape(len(chunks), win.shape[1], FILTERS)
    return np.maximum(out.max(axis=1) + w["bias"], 0)


def slopes(w: dict, chunks: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Slope of the mean log loss (and of the decay) in each weight; ``sizes`` chunks belong to each document in turn."""
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    act, where, win = activations(w, chunks)
    top = np.maximum.reduceat(act, first)
    mean = np.add.reduceat(act, first) / sizes[:, None]
    features = np.hstack([top, mean])
    p = 1 / (1 + np.exp(-np.clip(features @ w["out"] + w["base"], -30, 30)))
    error = ((p - labels) / len(sizes)).astype(np.float32)
    g = {"out": features.T @ error + DECAY * w["out"], "base": error.sum(keepdims=True)}
    to_features = error[:, None] * w["out"]
    share = act == top[owner]
    ties = np.add.reduceat(share.astype(np.float32), first)
    d_act = (share * (to_features[:, :FILTERS] / ties)[owner] + (to_features[:, FILTERS:] / sizes[:, None])[owner]) * (act > 0)
    g["bias"] = d_act.sum(axis=0)
    picked = np.take_along_axis(win, where[:, :, None], axis=1)                 # (chunks, FILTERS, WIDTH * DIMENSIONS)
    g["filters"] = np.einsum("cf,cfk->kf", d_act, picked) + DECAY * w["filters"]
    to_win = d_act[:, :, None] * w["filters"].T                                 # the same shape
    places = where[:, :, None] * STRIDE + np.arange(WIDTH)
    ids = np.take_along_axis(chunks[:, None, :].repeat(FILTERS, axis=1), places, axis=2)
    g["bytes"] = np.zeros_like(w["bytes"])
    np.add.at(g["bytes"], ids.ravel(), to_win.reshape(-1, DIMENSIONS))
    return g


def train(texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on the log loss of whole documents; each step takes as many documents of either class."""
    w = new_weights(seed)
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    cut = [chunks_of(t) for t in texts]
    draw = np.random.default_rng(seed)
    classes = [np.flatnonzero(labels == k) for k in (0, 1)]
    for step in range(1, steps + 1):
        docs = np.concatenate([draw.choice(c, DOCS_A_STEP // 2, replace=len(c) < DOCS_A_STEP // 2) for c in classes])
        sizes = np.array([len(cut[d]) for d in docs])
        g = slopes(w, np.concatenate([cut[d] for d in docs]), sizes, labels[docs])
        rate = RATE * (1 - step / (steps + 1))
        for k in w:
            m[k] += 0.1 * (g[k] - m[k])
            v[k] += 0.001 * (g[k] ** 2 - v[k])
            w[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return w


def logit(w: dict, text: bytes) -> float:
    cut = chunks_of(text)
    act = np.concatenate([pooled(w, cut[i: i + 256]) for i in range(0, len(cut), 256)])
    return float(np.concatenate([act.max(axis=0), act.mean(axis=0)]) @ w["out"] + w["base"][0])


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, per_class: int, max_bytes: int
                    ) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` rows (doc_id, text, label) of each class, and how many labels each class has in all."""
    usable = labels.where(may_learn & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ids = [usable.where(F.col("label") == k).dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
           for k in (0, 1)]
    chosen = F.broadcast(ids[0].unionByName(ids[1]))            # 2 * per_class rows at most
    rows = (id_text(docs).join(chosen, "doc_id").where(F.octet_length("text") <= max_bytes)
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")))        # repeated ids: one text
    return rows, counts


def fit(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column,
        per_class: int = SAMPLE_PER_CLASS, max_bytes: int = SAMPLE_BYTES) -> dict:
    """Model: weights, and the shift from equal classes to the shares of all labels."""
    rows, counts = sample_labelled(docs, labels, label, may_learn, per_class, max_bytes)
    got = sorted(((r.doc_id, r.label, r.text) for r in rows.collect()), key=lambda r: r[:2])
    y = np.array([r[1] for r in got], dtype=np.float32)
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if not n0 or not n1 or not 0 < y.sum() < len(y):
        return {"weights": None, "shift": 0.5 if n0 + n1 == 0 else n1 / (n0 + n1)}
    # training sees the classes in equal parts
    return {"weights": train([r[2].encode() for r in got], y), "shift": float(np.log(n1 / n0))}


def probability(model: dict, text: str | None) -> float:
    """The probability of label 1; the plain share where nothing could be learned."""
    if model["weights"] is None:
        return float(model["shift"])
    return float(1 / (1 + np.exp(-np.clip(logit(model["weights"], (text or "").encode()) + model["shift"], -30, 30))))


def score(docs: DataFrame, model: dict, *more: str) -> DataFrame:
    """(doc_id, ``more``..., score double): the probability of label 1 for each whole text."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (docs.schema[c] for c in ("doc_id", *more)))

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                scores = [probability(model, x) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", *more)), pa.array(scores, pa.float64())],
                                                 names=["doc_id", *more, "score"])
        return step

    return map_batches(id_text(docs, *more), make, f"{kinds}, score double")


def keep_scored(docs: DataFrame, model: dict, least: float) -> DataFrame:
    """``docs``, all columns, without the documents whose probability is under ``least``."""
    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                keep = [probability(model, x) >= least for x in part.column("text").to_pylist()]
                yield part.filter(pa.array(keep, pa.bool_()))
        return step

    return map_batches(docs, make, docs.schema)
