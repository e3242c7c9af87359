"""Alignment of two tokenizers over a corpus, with corpus-wide pair counts by external sorted runs.

``align_documents(docs, a_json, b_model)`` encodes every text by a byte-level tokenizer (A) and a
sentencepiece model (B), cuts both token sequences at the byte offsets where tokens of both end, links the two tokens
that end together, counts over the corpus how many links hold each (A id, B id) pair, and gives each document how many of its
links are best for their B id and the sum of their counts.

1. Words.  Neither tokenizer has a token that reaches from a sign into the blank after it, so a text is cut there and each distinct word
   is encoded, compared byte by byte and aligned once per task.
2. Runs.  For each slice of about 4 MB of text the links become (pair, document, times) records, sorted with the B id first.
   They are radix-partitioned by B id into ``PARTS`` parts; each part is one zstandard-compressed run, a row of a table in the shared folder.
3. Counts.  Groups of about ``FAN_IN`` runs of a part go through a k-way heap merge that adds up equal pairs, level by level until each part is one run.  A
   run of counts has one entry for each distinct pair, so frequent pairs collapse at the first level.  B ids stand together in it,
   so their highest counts are read off the last merge.
4. Back.  The runs of each group meet their part's counts; equal pairs are found by one pass over both, and each run's
   contributions are added up per document.

Groups hold a bounded number of runs, whatever a pair's frequency; no task gathers a part's records.

Defined cases: texts that are null or empty, or whose tokens do not spell a blank and the text, have no tokens: zeros and an empty digest; repeated rows and rows
without an id count and return each on its own; an empty table gives no rows; extra columns pass by.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialframe.llm.bpe import Numbering, gather
from trialframe.llm.common import id_text, map_batches, shared_table, slices
from trialframe.llm.token_store import SPACE, RunEncoder

PARTS = 16              # radix parts by B id
FAN_IN = 64             # runs merged at once, on average
WORDS_KEPT, OFTEN = 200_000, 3      # distinct words remembered before the rare ones are forgotten
LEVEL = 3
BLANK = "▁"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 signs for themselves, 256 and up for the rest."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordAligner:
    """Encodes and aligns the distinct words of texts; remembers those of earlier texts of the same task, up to a bound."""

    def __init__(self, a_json: str, b_model: str):
        import sentencepiece

        self.a = RunEncoder(a_json)
        stand_in = byte_alphabet()
        self.a_bytes = {i: bytes(stand_in[c] for c in token) if all(c in stand_in for c in token) else token.encode()
                        for token, i in self.a.tokenizer.get_vocab().items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.b_blank = self.b.piece_to_id(BLANK)
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece reaches from a sign into a blank: words cannot be encoded apart")
        blankless = SPACE.replace(" ", "")
        self.split = re.compile(f" [{SPACE}]*[^{SPACE}]*(?:[{blankless}][{SPACE}]*[^{SPACE}]*)*").findall
        self.keep([])

    def keep(self, which: list[int]) -> None:
        """Forget all words but these."""
        words = self.words.since(0) if which else []
        kept = Numbering([words[i] for i in which])
        at = np.array(which, dtype=np.int64)
        if which:
            self.pairs = gather(self.pairs, self.starts, self.links, at)
            self.digest = [self.digest[i] for i in which]
            self.n_a, self.n_b, self.links, self.good, self.times = (x[at] for x in (self.n_a, self.n_b, self.links, self.good, self.times))
        else:
            self.pairs, self.digest, self.good = np.zeros(0, dtype=np.int64), [], np.zeros(0, dtype=bool)
            self.n_a = self.n_b = self.links = self.times = np.zeros(0, dtype=np.int64)
        self.words = kept
        self.starts = np.cumsum(self.links) - self.links

    def a_ids(self, words: list[str]) -> list[np.ndarray]:
        if self.a.fence is None or any(t in "".join(words) for t in self.a.added):
            return self.a.apart(words)
        ids, counts = self.a.fenced(words)
        return np.split(ids, np.cumsum(counts)[:-1])

    def align(self, word: str, a: list[int], b: list[int]) -> tuple[bool, bytes, list[int]]:
        """(spelled right, groups as text, pairs that end together)."""
        a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        raw = word.encode("utf-8", "surrogatepass")
        if b"".join(a_parts) != raw or b"".join(b_parts) != raw:
            return False, b"", []
        groups, pairs, i, j, i0, j0, at, bt = [], [], 0, 0, 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if at <= bt and i < len(a):
                at += len(a_parts[i])
                i += 1
            else:
                bt += len(b_parts[j])
                j += 1
            if at == bt:
                groups.append(f"{','.join(map(str, a[i0:i]))}|{','.join(map(str, b[j0:j]))}")
                pairs.append(b[j - 1] << 32 | a[i - 1])
                i0, j0 = i, j
        return True, ";".join(groups).encode(), pairs

    def learn(self) -> None:
        fresh = self.words.since(len(self.digest))
        for begin in range(0, len(fresh), 20_000):
            words = fresh[begin:begin + 20_000]
            b_all = self.b.encode([w[1:] for w in words], num_threads=1)
            flat, counts, good, n_a, n_b = [], [], [], [], []
            for word, a, b in zip(words, self.a_ids(words), b_all, strict=True):
                b = [self.b_blank] if word == " " else b
                ok, text, pairs = self.align(word, a.tolist(), b)
                self.digest.append(text)
                flat += pairs
                counts.append(len(pairs))
                good.append(ok)
                n_a.append(len(a))
                n_b.append(len(b))
            self.pairs = np.append(self.pairs, np.array(flat, dtype=np.int64))
            self.links, self.good = np.append(self.links, np.array(counts, dtype=np.int64)), np.append(self.good, good)
            self.n_a, self.n_b = np.append(self.n_a, n_a), np.append(self.n_b, n_b)
        self.starts = np.cumsum(self.links) - self.links
        self.times = np.append(self.times, np.zeros(len(self.words) - len(self.times), dtype=np.int64))

    def documents(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """Facts (n_a, n_b, n_groups, n_links, digest) of each text, and pair and document of every link."""
        if len(self.words) > WORDS_KEPT:
            self.keep(np.flatnonzero(self.times >= OFTEN)[-WORDS_KEPT // 2:].tolist())
        seen = [self.words.numbers_of(self.split(" " + text)) for text in texts]
        self.learn()
        facts, flat, owner = [], [], []
        for i, words in enumerate(seen):
            np.add.at(self.times, words, 1)
            if not texts[i] or not self.good[words].all():
                facts.append((0, 0, 0, 0, ""))
                continue
            text = hashlib.sha256(b";".join([self.digest[w] for w in words.tolist()])).hexdigest()
            n = int(self.links[words].sum())
            facts.append((int(self.n_a[words].sum()), int(self.n_b[words].sum()), n, n, text))
            flat.append(words)
            owner.append(np.full(n, i, dtype=np.int64))
        if not flat:
            return facts, self.pairs[:0], np.zeros(0, dtype=np.int64)
        return facts, gather(self.pairs, self.starts, self.links, np.concatenate(flat)), np.concatenate(owner)


def packed(*columns: np.ndarray) -> bytes:
    """Integer columns in one zstandard frame: their lengths, then their values."""
    head = np.array([len(columns), *map(len, columns)], dtype="<i8").tobytes()
    return zstandard.ZstdCompressor(level=LEVEL).compress(head + b"".join(c.astype("<i8").tobytes() for c in columns))


def unpacked(run: bytes) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(run), dtype="<i8")
    sizes = data[1:1 + int(data[0])]
    return np.split(data[1 + len(sizes):], np.cumsum(sizes)[:-1])


def with_steps(sorted_keys: np.ndarray) -> np.ndarray:
    return np.diff(sorted_keys, prepend=0)


def slice_runs(pairs: np.ndarray, owner: np.ndarray, n_docs: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(part, counts run, entries run) of a slice's links; entries are documents and times under each pair."""
    keys, which = np.unique(pairs, return_inverse=True)
    records, times = np.unique(which * n_docs + owner, return_counts=True)
    key_of, doc = records // n_docs, records % n_docs
    part_of = (keys >> 32) % PARTS
    for part in np.unique(part_of).tolist():
        mine = np.flatnonzero(part_of == part)
        rows = np.flatnonzero(part_of[key_of] == part)
        first = np.flatnonzero(np.diff(key_of[rows], prepend=-1))
        sums = np.add.reduceat(times[rows], first)
        sizes = np.diff(np.append(first, len(rows)))
        yield part, packed(with_steps(keys[mine]), sums), packed(sizes, doc[rows], times[rows])


def merge_counts(last: bool):
    """K-way heap merge of the counts runs of one group; at the last level also which pairs are their B id's most frequent."""
    def run(table: pa.Table) -> pa.Table:
        streams = []
        for frame in table.column("counts"):
            steps, sums = unpacked(frame.as_py())
            streams.append(zip(np.cumsum(steps).tolist(), sums.tolist(), strict=True))
        keys, totals, held = array("q"), array("q"), -1
        for key, n in heapq.merge(*streams):
            if key == held:
                totals[-1] += n
            else:
                keys.append(key)
                totals.append(n)
                held = key
        keys, totals = np.frombuffer(keys, dtype=np.int64), np.frombuffer(totals, dtype=np.int64)
        columns = [with_steps(keys), totals]
        if last:
            first = np.flatnonzero(np.diff(keys >> 32, prepend=-1))
            columns.append(totals == np.repeat(np.maximum.reduceat(totals, first), np.diff(np.append(first, len(keys)))))
        return pa.table({"part": table.column("part")[:1], "slice": table.column("slice")[:1], "counts": pa.array([packed(*columns)], pa.binary())})
    return run


def contribute(runs: pa.Table, counts: pa.Table) -> pa.Table:
    """(slice, place, n_best, count_sum) of the documents of a group's runs."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    if runs.num_rows:
        steps, totals, best = unpacked(counts.column("counts")[0].as_py())
        keys = np.cumsum(steps)
        for name, frame, entries in zip(*(runs.column(c) for c in ("slice", "counts", "entries")), strict=True):
            mine = np.cumsum(unpacked(frame.as_py())[0])
            sizes, doc, times = unpacked(entries.as_py())
            at = np.repeat(np.searchsorted(keys, mine), sizes)
            places, inverse = np.unique(doc, return_inverse=True)
            sums = np.zeros((2, len(places)), dtype=np.int64)
            np.add.at(sums[0], inverse, times * best[at])
            np.add.at(sums[1], inverse, times * totals[at])
            for to, values in zip(out, (np.fromiter(repeat(name.as_py(), len(places)), dtype=np.int64), places, *sums), strict=True):
                to.append(values)
    columns = [np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in out]
    return pa.table(dict(zip(("slice", "place", "n_best", "count_sum"), columns, strict=True)))


def align_documents(docs: DataFrame, a_json: str, b_model: str, fan_in: int = FAN_IN) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        aligner, state = WordAligner(a_json, b_model), {"slice": TaskContext.get().partitionId() << 32}

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                facts, pairs, owner = aligner.documents(part.column("text").to_pylist())
                name, n = state["slice"], part.num_rows
                state["slice"] += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*facts, strict=True), [*[pa.int64()] * 4, pa.string()], strict=True)]
                nothing = [pa.nulls(n, t) for t in (pa.int32(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.int64()), *nothing, pa.array(range(n), pa.int64()), part.column("doc_id"), *columns],
                                                 names=_NAMES)
                runs = list(slice_runs(pairs, owner, n)) if len(pairs) else []
                if runs:
                    fields = [pa.array(c, t) for c, t in zip(zip(*runs, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)]
                    empty = [pa.nulls(len(runs), t) for t in (pa.int64(), part.schema.field("doc_id").type, *[pa.int64()] * 4, pa.string())]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(runs), pa.int64()), *fields, *empty], names=_NAMES)
        return step

    records = shared_table(map_batches(id_text(docs), make, "slice long, part int, counts binary, entries binary, place long, "
                                       f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"), "alignments")
    facts = records.where("part is null").select("slice", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    runs = records.where("part is not null").select("part", "slice", "counts", "entries")
    back = contributions(runs, fan_in)
    number = lambda c: F.coalesce(c, F.lit(0)).alias(c)      # noqa: E731
    return (facts.join(back, ["slice", "place"], "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", number("n_best"), number("count_sum"), "groups_sha256"))


_NAMES = ["slice", "part", "counts", "entries", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def pair_counts(runs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(part, slice, counts): one run of counts for each part, with each B id's most frequent pairs marked."""
    level, turn = runs.select("part", "slice", "counts"), 0
    while True:
        n = level.groupBy("part").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        groups = -(-n // fan_in)
        merged = (level.withColumn("g", F.pmod(F.xxhash64("slice", F.lit(turn)), F.lit(max(groups, 1)))).groupBy("part", "g")
                  .applyInArrow(merge_counts(groups <= 1), "part int, slice long, counts binary"))
        level = shared_table(merged, "pair-counts")
        if groups <= 1:
            return level
        turn += 1


def contributions(runs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(slice, place, n_best, count_sum) of all documents with links."""
    counts = pair_counts(runs, fan_in).select("part", "counts")
    n = runs.groupBy("part").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    groups = max(-(-n // fan_in), 1)
    mine = runs.withColumn("g", F.pmod(F.xxhash64("slice"), F.lit(groups)))
    each = counts.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    found = mine.groupBy("part", "g").cogroup(each.groupBy("part", "g")).applyInArrow(
        contribute, "slice long, place long, n_best long, count_sum long")
    return found.groupBy("slice", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
