"""Benchmark decontamination: BM25 over test items, searched with block-max WAND.

The test items are the indexed documents, the training passages are the queries.
An item's words are cut into units of at most ``UNIT`` words; a training text is cut into
passages of ``PASSAGE`` words that overlap by half, so every run of ``UNIT`` words stands
whole in some passage.  Impacts are BM25 weights divided by the unit's own total, so a score
is the weighted share of a unit that a passage covers.  A unit is retrieved at ``THRESHOLD`` or, if that is less, at what
remains of its weight when the edits that verification allows take its heaviest words: so retrieval
loses no copy that the edits of one item make.  Impacts are scaled to make this the one threshold of the search.  For each passage, block-max WAND retrieves every unit whose score
reaches the threshold: bounds on terms pick the pivot, bounds on blocks of units skip ahead, and
only then are postings scored.  The sums of the block bounds are first taken for all passages of a
text at once, and a passage of which no block can reach the threshold opens no postings.

Each (document, item) retrieved is verified on the whole text.  It is a leak if one of these
shares reaches its bound: those of the question's and of the answer's runs of ``GRAM`` words
(``QUESTION`` and ``ANSWER``, both); that of the whole item (``ITEM``); or that of a question of
``SHORT`` words or more without its answer (``ITEM``).  The last two are the larger of the share of
runs and of 1 - edits / words, where edits are the fewest words to replace, drop or insert
for the item to stand somewhere in the text; so an item of four words or more may have a word
changed wherever it is, a shorter one stands as it is.  The answer is the last sentence or line of an
item, or its last third where there is one only (such items have no question to find alone).
A question has units of its own, so that it is retrieved without the answer.

Document frequencies are counted over all items.  The index is used in chunks of about
``CHUNK_CHARS`` characters of items, each small enough to send to every task; more items
make more passes over the documents, with the same result.

Defined cases: null or empty texts on either side match nothing; repeated items or rows
give repeated rows only where their ids differ; null ids are kept; empty tables give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from trialframe.llm.common import id_text, map_batches, slices

UNIT, PASSAGE = 64, 128
K1, B = 1.2, 0.75
THRESHOLD = 0.6
BLOCK, INDEX_UNITS = 4, 1_024       # units per block; units of one index, so that its block bounds are a small array
GRAM, QUESTION, ANSWER, ITEM, SHORT = 3, 0.7, 0.7, 0.7, 8
CHUNK_CHARS = 2_000_000
WORDS = re.compile(r"[^\W_]+").findall


def words_of(text: str) -> list[str]:
    return WORDS(text.lower())


def units_of(text: str) -> list[list[str]]:
    """The item's units, and those of its question that differ."""
    words, question = words_of(text), lone_question(text)
    units = [words[i: i + UNIT] for i in range(0, len(words), UNIT)]
    return units + [u for u in (question[i: i + UNIT] for i in range(0, len(question), UNIT)) if u not in units]


def sentences(text: str) -> list[list[str]]:
    return [w for w in map(words_of, re.split(r"(?<=[.?!])\s+|\n+", text)) if w]


def lone_question(text: str) -> list[str]:
    """The words before the last sentence or line, if enough to be found without it."""
    question = [x for p in sentences(text)[:-1] for x in p]
    return question if len(question) >= SHORT else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = sentences(text)
    if len(parts) > 1:
        return [x for p in parts[:-1] for x in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    n = min(n, len(words))
    return {tuple(words[i: i + n]) for i in range(len(words) - n + 1)} if n else set()


def edits(item: list[str], words: list[str]) -> int:
    """The fewest word edits that turn ``item`` into some run of ``words`` (Myers' bit vectors)."""
    places: dict[str, int] = {}
    for k, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << k
    full, top = (1 << len(item)) - 1, 1 << len(item) >> 1
    up, down, now = full, 0, len(item)
    best = now
    for w in words:
        same = places.get(w, 0)
        x = same | down
        h = (((same & up) + up) ^ up) | same
        more, less = down | (full & ~(h | up)), up & h
        if more & top:
            now += 1
        elif less & top:
            now -= 1
            best = min(best, now)
        more, less = more << 1 & full, less << 1 & full
        up, down = less | (full & ~(x | more)), more & x
    return best


def near(item: list[str], words: list[str], held: set[str]) -> float:
    """1 - edits / words of the item; 0 where too few of its words stand in the text to reach ``ITEM``."""
    if sum(w in held for w in item) < ITEM * len(item) - 1e-9:
        return 0.0
    return 1 - edits(item, words) / len(item)


class Index:
    """Postings, term bounds and block bounds of one chunk of units."""

    def __init__(self, items: list[tuple], df: dict[str, int], n_units: int, mean_words: float, threshold: float = THRESHOLD):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        postings: dict[str, list[tuple[int, float]]] = {}
        self.owner: list[int] = []
        for at, (_, text) in enumerate(items):
            for unit in units_of(text):
                tf: dict[str, int] = {}
                for w in unit:
                    tf[w] = tf.get(w, 0) + 1
                norm = K1 * (1 - B + B * len(unit) / mean_words)
                raw = {w: math.log(1 + (n_units - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + norm) for w, n in tf.items()}
                total = sum(raw.values())
                lost = sorted(raw.values(), reverse=True)[:int((1 - ITEM) * len(unit) + 1e-9)]       # the most that edits can take
                need = min(threshold, 1 - sum(lost) / total)
                for w, x in raw.items():
                    postings.setdefault(w, []).append((len(self.owner), x / total * (threshold / need)))
                self.owner.append(at)
        self.term = {w: k for k, w in enumerate(sorted(postings))}
        self.units = [[u for u, _ in postings[w]] for w in self.term]
        self.impacts = [[x for _, x in postings[w]] for w in self.term]
        self.bound = np.array([max(x) for x in self.impacts], dtype=np.float64)
        self.block = BLOCK
        self.block_bound = []                       # term -> {block: largest impact}
        for units, impacts in zip(self.units, self.impacts, strict=True):
            by: dict[int, float] = {}
            for u, x in zip(units, impacts, strict=True):
                by[u // self.block] = max(by.get(u // self.block, 0.0), x)
            self.block_bound.append(by)
        self.bounds = np.zeros((len(self.term), -(-len(self.owner) // self.block)), dtype=np.float32)
        for t, by in enumerate(self.block_bound):
            for b, x in by.items():
                self.bounds[t, b] = np.nextafter(np.float32(x), np.float32(np.inf))

    def search(self, terms: list[int], threshold: float, live: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: every unit whose impacts over ``terms`` (distinct) sum to the threshold.  ``live`` are the
        blocks, ascending, whose bounds reach it; all others are skipped without opening a posting."""
        end, size = len(self.owner), self.block
        units, impacts, bound = self.units, self.impacts, self.bound
        first = [b * size for b in live]
        cursors = [[units[t][0], t, 0] for t in terms]              # unit, term, place in its postings
        found, slack = [], threshold - 1e-9

        def seek(cursor: list, unit: int) -> None:
            """To the first posting at or after ``unit`` that lies in a live block."""
            held = units[cursor[1]]
            at = bisect_left(held, unit, cursor[2])
            while at < len(held):
                k = bisect_right(first, held[at]) - 1
                if k >= 0 and held[at] < first[k] + size:
                    break
                if k + 1 == len(first):
                    at = len(held)
                    break
                at = bisect_left(held, first[k + 1], at)
            cursor[2] = at
            cursor[0] = held[at] if at < len(held) else end

        for c in cursors:
            seek(c, 0)
        cursors = [c for c in cursors if c[0] < end]
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += bound[c[1]]
                if total >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            unit = cursors[pivot][0]
            if cursors[0][0] == unit:
                score, last = 0.0, 0
                for c in cursors:
                    if c[0] != unit:
                        break
                    score += impacts[c[1]][c[2]]
                    last += 1
                if score >= slack:
                    found.append((unit, score))
                for c in cursors[:last]:
                    seek(c, unit + 1)
            else:
                for c in cursors[:pivot]:
                    if c[0] < unit:
                        seek(c, unit)
            cursors = [c for c in cursors if c[0] < end]
        return found

    def retrieve(self, words: list[str], threshold: float) -> dict[int, tuple[float, int]]:
        """item -> (best score, first word of that passage) over all passages of a text."""
        ids = np.fromiter(map(self.term.get, words, repeat(-1)), dtype=np.int32, count=len(words))
        at = np.flatnonzero(ids >= 0)
        best: dict[int, tuple[float, int]] = {}
        if not len(at):
            return best
        held = ids[at]
        order = np.lexsort((at, held))
        same = np.append(False, held[order][1:] == held[order][:-1])
        previous = np.full(len(at), -1)
        previous[order[same]] = at[order[np.flatnonzero(same) - 1]]  # the same word's place before
        half = PASSAGE // 2
        slot = at // half                       # passage k is slots k and k + 1
        reach = np.zeros((int(slot[-1]) + 2, self.bounds.shape[1]), dtype=np.float32)
        for passage in (slot, slot - 1):        # each word counts once in a passage
            once = np.flatnonzero((previous < passage * half) & (passage >= 0))
            if len(once):
                where, first = np.unique(passage[once], return_index=True)
                reach[where] += np.add.reduceat(self.bounds[held[once]], first, axis=0)
        for k in np.flatnonzero(reach.max(axis=1) >= threshold - 1e-4).tolist():
            low, high = np.searchsorted(at, (k * half, k * half + PASSAGE))
            live = np.flatnonzero(reach[k] >= threshold - 1e-4).tolist()
            for unit, score in self.search(np.unique(held[low:high]).tolist(), threshold, live):
                item = self.owner[unit]
                if item not in best or score > best[item][0]:
                    best[item] = (score, k * half)
        return best

    def verify(self, item: int, words: list[str], runs: set, held: set) -> tuple[float, float, float, bool]:
        """Shares of the question, of the answer and of the whole item that stand in the text; is it a leak?"""
        text = self.texts[item]
        whole = words_of(text)

        def share(part: list[str]) -> float:
            if len(part) >= GRAM:
                wanted = grams(part, GRAM)
                return len(wanted & runs) / len(wanted)
            n = len(part)
            return float(any(words[i: i + n] == part for i in range(len(words) - n + 1)))

        def stands(part: list[str]) -> float:
            if len(part) < SHORT:
                return near(part, words, held)
            by_runs = share(part)
            return by_runs if by_runs >= ITEM else max(by_runs, near(part, words, held))

        asked, told = map(share, question_and_answer(text))
        item_share = stands(whole)
        question = lone_question(text)
        leak = (item_share >= ITEM or (len(whole) >= SHORT and asked >= QUESTION and told >= ANSWER)
                or bool(question) and stands(question) >= ITEM)
        return asked, told, item_share, leak


def indexes(items: list[tuple], df: dict[str, int], n_units: int, mean_words: float, threshold: float = THRESHOLD) -> list[Index]:
    """Indexes of at most ``INDEX_UNITS`` units, or of one item."""
    out, group, held = [], [], 0
    for item in items:
        n = len(units_of(item[1]))
        if group and held + n > INDEX_UNITS:
            out.append(Index(group, df, n_units, mean_words, threshold))
            group, held = [], 0
        group.append(item)
        held += n
    return [*out, Index(group, df, n_units, mean_words, threshold)] if held else out


def item_terms(items: DataFrame) -> DataFrame:
    """(part, words int, terms array<string>): the units of the items, for the counts."""
    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            units = [u for t in batch.column("text").to_pylist() for u in units_of(t)]
            yield pa.RecordBatch.from_arrays([pa.array([len(u) for u in units], pa.int32()),
                                              pa.array([sorted(set(u)) for u in units], pa.list_(pa.string()))], names=["words", "terms"])
        return step
    return map_batches(items.select("text"), make, "words int, terms array<string>")


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, bm25, question_overlap, answer_overlap, item_overlap, first_word) of every verified match; ``bm25`` is scaled
    so that ``threshold`` is where the unit is retrieved."""
    spark = docs.sparkSession
    kinds = [docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()]
    texts = items.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    units = item_terms(texts)
    facts = units.agg(F.count("*").alias("n"), F.avg("words").alias("mean")).first()
    chars = texts.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, bm25 double, question_overlap double, answer_overlap double, item_overlap double, first_word long"
    if not facts.n:
        return spark.createDataFrame([], schema)
    parts = max(1, math.ceil(chars / CHUNK_CHARS))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    counts = units.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    rows = id_text(docs)
    found = None
    for k in range(parts):          # each chunk's items, and the counts of their terms, are bounded
        own = texts.where(part == k)
        held = sorted(((r.item_id, r.text) for r in own.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        terms = item_terms(own).select(F.explode("terms").alias("term")).distinct()
        df = {r.term: r.df for r in counts.join(terms, "term").collect()}
        leaks = map_batches(rows, _searcher(spark.sparkContext.broadcast((held, df, facts.n, facts.mean)), threshold,
                                                to_arrow_type(items.schema["item_id"].dataType)), schema)
        found = leaks if found is None else found.unionByName(leaks)
    return found


def _searcher(shared, threshold: float, item_kind: pa.DataType):
    def make():
        held = indexes(*shared.value, threshold)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                out: list[tuple] = []
                for at, text in enumerate(part.column("text").to_pylist()):
                    words, runs, seen = words_of(text), None, set()
                    for index in held:
                        best = index.retrieve(words, threshold)
                        if best and runs is None:
                            runs, seen = grams(words, GRAM), set(words)
                        for item, (score, first) in sorted(best.items()):
                            *shares, leak = index.verify(item, words, runs, seen)
                            if leak:
                                out.append((at, index.ids[item], score, *shares, first))
                if out:
                    at, item, *rest = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(at)), pa.array(item, item_kind),
                         *(pa.array(x, pa.float64()) for x in rest[:4]), pa.array(rest[4], pa.int64())],
                        names=["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap", "item_overlap", "first_word"])
        return step
    return make


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that hold an item (by ``doc_id``)."""
    leaks = find_leaks(docs, items, threshold).select("doc_id").distinct().withColumnRenamed("doc_id", "leak_id")
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["leak_id"]), "left_anti")
