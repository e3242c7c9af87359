"""Byte-level BPE encoding and decoding by corpus-level merge replay.

``encode_documents(docs, ranks_path, pattern)`` returns one row per input row
with the token ids, ``decode_documents(encoded, ranks_path)`` gives the bytes back.

Method.  Each block of documents (an Arrow batch) is reduced to its distinct
pre-tokens; every word is then held once in flat arrays of positions.  An
inverted index leads from a token pair, named by the token that it forms, to the
positions where it stands.  Pairs leave the index in rank order; each merge
touches only the merged positions and their two neighbours, whose new pairs
enter the index.  Words are independent, so the replay of a block gives each of
its words the ids that a replay over the whole corpus would give, and needs no
shuffle: a lost task is simply run again.

Defined cases: null text = empty text = no ids; repeated rows give repeated
rows; a null ``doc_id`` stays null; other columns of ``docs`` are dropped; an
empty table gives an empty result; length is bounded by memory for one text.
"""

from __future__ import annotations

import base64
import collections
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import regex
from pyspark.sql import DataFrame

from trialframe.llm.common import id_text, map_batches, slices

REPLAY_BYTES = 4 << 20      # bytes of distinct words replayed together
VOCABULARY_KEPT = 200_000   # distinct words remembered by a task before it starts afresh


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class TokenBytes:
    """The bytes of each id of a rank file, in one array."""

    def __init__(self, ranks: dict[bytes, int]):
        token_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            token_bytes[rank] = token
        self.lengths = np.array([len(t) for t in token_bytes], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(token_bytes), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.blob, self.starts, self.lengths, ids).tobytes()


class MergeReplay(TokenBytes):
    """Replays the merges of a rank file over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__(ranks)
        self.ranks = ranks
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_forms = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int32)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.byte_pairs = self.formed(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)

    def formed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair forms, -1 where it forms none."""
        if not len(self.pair_keys):
            return np.full(len(left), -1, dtype=np.int32)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_forms[at], -1).astype(np.int32)

    def one_word(self, word: bytes) -> list[int]:
        """Plain merging of a single word, leftmost lowest rank first."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            best = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all (non-empty) words one after another, and how many each word has."""
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        end = len(text)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        token = np.append(self.byte_ids[text], np.int32(-1))
        after = np.arange(1, end + 2, dtype=np.int32)
        before = np.arange(-1, end, dtype=np.int32)
        after[first + sizes - 1] = end
        before[first] = -1
        alive = np.ones(end + 1, dtype=bool)
        pair = np.full(end + 1, -1, dtype=np.int32)     # what each position and its successor form
        inner = np.flatnonzero(after[:end] < end)
        pair[inner] = self.byte_pairs[text[inner], text[inner + 1]]

        index: dict[int, list[np.ndarray]] = {}         # formed token -> positions
        ranks: list[int] = []                           # heap over the index's keys

        def enter(at: np.ndarray, forms: np.ndarray) -> None:
            some = forms >= 0
            at, forms = at[some], forms[some]
            if not len(at):
                return
            order = np.argsort(forms, kind="stable")
            at, forms = at[order], forms[order]
            cuts = np.flatnonzero(np.diff(forms)) + 1
            lows = [0, *cuts.tolist()]
            for low, high, form in zip(lows, [*cuts.tolist(), len(at)], forms[lows].tolist(), strict=True):
                if form in index:
                    index[form].append(at[low:high])
                else:
                    index[form] = [at[low:high]]
                    heapq.heappush(ranks, form)

        enter(inner, pair[inner])
        again: set[int] = set()      # words where a merge opened a lower rank before its equals were done
        while ranks:
            form = heapq.heappop(ranks)
            lists = index.pop(form)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[pair[at] == form]
            if not len(at):
                continue
            if len(at) > 1:
                if len(lists) == 1:
                    at = np.unique(at)
                touching = after[at[:-1]] == at[1:]     # overlapping pairs, as in "aaa": every second one merges
                if touching.any():
                    place = np.arange(len(at))
                    heads = np.maximum.accumulate(np.where(np.append(False, touching), 0, place))
                    at = at[(place - heads) % 2 == 0]
            gone = after[at]
            follow = after[gone]
            token[at] = form
            alive[gone] = False
            pair[gone] = -1
            after[at] = follow
            before[follow] = at
            pair[at] = -1
            ahead = at[follow < end]
            made = self.formed(token[ahead], token[after[ahead]])
            pair[ahead] = made
            back = before[at]
            back = back[back >= 0]
            made_back = self.formed(token[back], token[after[back]])
            pair[back] = made_back
            touched, forms = np.concatenate([ahead, back]), np.concatenate([made, made_back])
            lower = (forms >= 0) & (forms < form)
            if lower.any() and len(at) > 1:
                owner, held = np.unique(np.searchsorted(first, at, side="right") - 1, return_counts=True)
                opened = np.unique(np.searchsorted(first, touched[lower], side="right") - 1)
                again.update(np.intersect1d(owner[held > 1], opened).tolist())
            enter(touched, forms)
        ids = token[:end][alive[:end]].astype(np.uint32)
        counts = np.add.reduceat(alive[:end].astype(np.int64), first) if len(words) else np.zeros(0, dtype=np.int64)
        if again:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for w in again:
                parts[w] = np.array(self.one_word(words[w]), dtype=np.uint32)
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
        return ids, counts


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[w] : starts[w] + lengths[w]]`` for each ``w``, one after another."""
    n = lengths[which]
    total = int(n.sum())
    if not total:
        return flat[:0]
    shift = starts[which] - (np.cumsum(n) - n)
    return flat[np.repeat(shift, n) + np.arange(total)]


class Numbering:
    """Numbers words in order of first sight."""

    def __init__(self, words: list[str] = ()):
        # a word not yet seen gets the next number; memory goes with the distinct words, not with all that was seen
        self.first: dict[str, int] = collections.defaultdict(itertools.count(len(words)).__next__, zip(words, itertools.count()))

    def __len__(self) -> int:
        return len(self.first)

    def numbers_of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.first.__getitem__, words), dtype=np.int32, count=len(words))

    def since(self, n: int) -> list[str]:
        return list(itertools.islice(self.first, n, None))


class CorpusEncoder:
    """Encodes texts; remembers the words of earlier blocks of the same task, up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay, self.split = MergeReplay(ranks), regex.compile(pattern).findall
        self.reset()

    def reset(self) -> None:
        self.words = Numbering()
        self.flat = np.zeros(0, dtype=np.uint32)
        self.starts = self.counts = np.zeros(0, dtype=np.int64)

    def learn(self) -> None:
        """Replay the merges over the words seen since the last call."""
        fresh = self.words.since(len(self.counts))
        flats, counts, group, held = [self.flat], [self.counts], [], 0
        for word in fresh:
            data = word.encode("utf-8", "surrogatepass")
            group.append(data)
            held += len(data)
            if held >= REPLAY_BYTES:
                for to, got in zip((flats, counts), self.replay.encode_words(group), strict=True):
                    to.append(got)
                group, held = [], 0
        if group:
            for to, got in zip((flats, counts), self.replay.encode_words(group), strict=True):
                to.append(got)
        self.flat, self.counts = np.concatenate(flats), np.concatenate(counts)
        self.starts = np.cumsum(self.counts) - self.counts

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.words) > VOCABULARY_KEPT:
            self.reset()
        seen = [self.words.numbers_of(self.split(text)) for text in texts]
        self.learn()
        for numbers in seen:
            yield gather(self.flat, self.starts, self.counts, numbers)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, *more: str) -> DataFrame:
    """(doc_id, ``more``..., n_tokens long, ids binary): ids as little-endian unsigned 32-bit integers."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (docs.schema[c] for c in ("doc_id", *more)))

    def make():
        encoder = CorpusEncoder(load_ranks(ranks_path), pattern)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                ids = [x.astype("<u4").tobytes() for x in encoder.encode(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", *more)), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], names=["doc_id", *more, "n_tokens", "ids"])
        return step

    return map_batches(id_text(docs, *more), make, f"{kinds}, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, ranks_path: str, *more: str) -> DataFrame:
    """(doc_id, ``more``..., decoded binary) from rows with ``ids`` as ``encode_documents`` gives them."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (encoded.schema[c] for c in ("doc_id", *more)))

    def make():
        tokens = TokenBytes(load_ranks(ranks_path))

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "ids"):
                decoded = [tokens.decode(np.frombuffer(x or b"", dtype="<u4")) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", *more)), pa.array(decoded, pa.binary())],
                                                 names=["doc_id", *more, "decoded"])
        return step

    return map_batches(encoded.select("doc_id", "ids", *(c for c in more if c != "ids")), make, f"{kinds}, decoded binary")

