"""N-gram Jaccard join by prefixes of single tokens and token combinations.

``join_components(docs, words, percent)`` links two documents when the Jaccard similarity
of their shingle sets (``words`` consecutive words) is at least ``percent`` / 100, and
returns each document with the smallest id that links reach.  All links count; none is
lost, and no group is expanded into its pairs.

1. Exact copies (equal shingle sets) become one class, named by its smallest id.
2. Candidates.  Let ``lacking(n)`` be how many of ``n`` tokens a partner may lack.  Of the
   ``lacking(n) + ext(n)`` tokens of smallest hash two similar sets share at least ``ext``
   of the smaller one, so a document most of whose smallest tokens stand in no other
   document has no partner and drops out.
3. Order by frequency.  The tokens of the remaining classes are counted over these
   classes, and each class sorts its own rarest first.  A prefix of ``lacking(n) + 1 + g``
   tokens shares ``1 + g`` tokens with any partner's.
4. Signatures.  Rare tokens of the prefix (``RARE`` classes at most) are indexed singly.  Frequent
   tokens are split into ``g`` token classes by hash; of ``1 + g`` shared frequent tokens two must
   fall into the same one, so 2-token combinations within a class are indexed.  ``g``
   grows with the set's size, which keeps the combinations linear in it.  Sets too
   small for ``g >= 1`` index frequent tokens singly.  A signature carries the set's size and how many
   of its tokens come before, all unshared at the first signature that a pair shares (length and
   positional filters).
5. Families.  Near copies share many signatures.  Each signature names the holder of smallest hash as its pivot, and the
   holders of a pivot's signatures form one family with the least place of each member: every pair of a
   signature meets in its pivot's family, but once and not once a signature.
6. Verification by whole sets.  In rounds, the members of each family first meet ``CENTRES`` of them; verified links merge
   components, and families inside one component close.  When few pairs between components are left, or a round no longer
   halves them, all of them are compared.  A pair is verified only if sizes, places and sketches allow it: a sketch
   holds for each of ``64 * SKETCH`` residues whether an odd number of tokens has it, so sketches differ in no more bits than
   the sets do in tokens.  A group of near copies thus costs a few checks a member, and pairs just below the
   threshold cost a comparison of sketches.

Set identity and tokens are 64- and 128-bit hashes (xxh3).  Broadcasts (ids of classes that
have candidates, pairs of one round) are used up to ``BROADCAST_ROWS`` rows and become
shuffled joins beyond.

Defined cases: null or empty text, or no word: empty set, linked with nothing,
``component_id`` is the own id; fewer words than ``words``: the whole sequence is the one
shingle; repeated rows each return; rows that share an id count as linked; a null
``doc_id`` returns with its class's component and links nothing; empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialframe.llm.bpe import Numbering
from trialframe.llm.common import counted_table, id_text, map_batches, shared_table, slices
from trialframe.llm.line_quality import window_hashes

RARE = 16
WORDS_KEPT = 150_000     # distinct words remembered by a task before it starts afresh
BROADCAST_ROWS = 1_000_000
ALL_PAIRS = 4           # remaining pairs are all compared once they are this many times the active classes,
                        # or once a round of centres no longer halves them
CENTRES = 4             # members of a family that the others meet in a round
SKETCH = 16             # 64-bit words of a sketch


class Bounds:
    """Sizes that the threshold implies."""

    def __init__(self, percent: int):
        if not 60 <= percent <= 100:
            raise ValueError("percent must be 60 to 100")
        self.percent = percent

    def lacking(self, n: int) -> int:
        """Tokens of ``n`` that a partner may lack."""
        return (100 - self.percent) * n // 100

    def least(self, n: int) -> int:
        """Size of the smallest partner."""
        return -(-self.percent * n // 100)

    def most(self, n: int) -> int:
        return 100 * n // self.percent

    def ext(self, n: int) -> int:
        return self.lacking(n) + 1

    def sent(self, n: int) -> int:
        return min(n, self.lacking(n) + self.ext(n))

    def shared(self, n: int) -> int:
        """Tokens among the sent ones that any partner shares and sends."""
        return self.ext(self.least(n))

    def classes(self, level: int) -> int:
        """Token classes for pairs whose larger set has 2**level to 2**(level + 1) - 1 tokens."""
        return self.lacking(self.least(self.least(1 << level))) // 2


class Shingler:
    """Shingle sets of texts; remembers the words of earlier texts of the same task, up to a bound."""

    def __init__(self, words: int):
        self.words = words
        self.reset()

    def reset(self) -> None:
        self.seen, self.hashes = Numbering(), np.zeros(0, dtype=np.uint64)

    def sets(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Sorted distinct 64-bit shingle hashes of each text."""
        if len(self.seen) > WORDS_KEPT:
            self.reset()
        numbers = [self.seen.numbers_of(text.encode().lower().split()) for text in texts]
        fresh = self.seen.since(len(self.hashes))
        self.hashes = np.concatenate([self.hashes, np.array([xxhash.xxh3_64_intdigest(w) for w in fresh], dtype=np.uint64)])
        h = self.hashes[np.concatenate(numbers)] if numbers else self.hashes[:0]
        runs = window_hashes(h, self.words) if len(h) >= self.words else h[:0]
        start = 0
        for p in numbers:
            n = len(p)
            if n >= self.words:
                yield np.unique(runs[start: start + n - self.words + 1])
            else:
                yield window_hashes(h[start: start + n], n) if n else h[:0]
            start += n


def shingles(docs: DataFrame, words: int, fields: str, make_row) -> DataFrame:
    """(doc_id, ``fields``...) from each document's shingle set; ``make_row(set)`` gives their values."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [f.split()[0] for f in fields.split(", ")]
    types = [_ARROW[f.split()[1]] for f in fields.split(", ")]

    def make():
        shingler = Shingler(words)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                columns = list(zip(*map(make_row, shingler.sets(part.column("text").to_pylist())), strict=True))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                                                 names=["doc_id", *names])
        return step

    return map_batches(id_text(docs), make, f"doc_id {kind}, {fields}")


_ARROW = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def set_key(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def mix(*parts) -> np.ndarray:
    out = np.uint64(0)
    with np.errstate(over="ignore"):
        for p in parts:
            out = (out ^ p) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def class_signatures(n: int, df: np.ndarray, h: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a class of ``n`` tokens, and how many of its tokens stand before each in the order;
    ``df`` and ``h`` are the tokens held by several classes, rarest first."""
    alone = n - len(h)                      # the others come first in the order
    levels = sorted({n.bit_length() - 1, bounds.most(n).bit_length() - 1})
    length = {at: max(0, bounds.lacking(n) + 1 + bounds.classes(at) - alone) for at in levels}
    head = max(length.values())
    rare = np.flatnonzero(df[:head] <= RARE)
    out, before = [mix(h[rare], np.uint64(1))], [alone + rare]
    for level in levels:
        head, split = length[level], bounds.classes(level)
        often = h[:head][df[:head] > RARE]
        if not split:
            out.append(mix(often, np.uint64(2), np.uint64(level)))
            before.append(alone + np.flatnonzero(df[:head] > RARE))
            continue
        owner = often % np.uint64(split)
        order = np.lexsort((often, owner))
        often, owner = often[order], owner[order]
        for step in range(1, len(often)):
            same = owner[step:] == owner[:-step]
            if not same.any():
                break
            out.append(mix(often[:-step][same], often[step:][same], np.uint64(3), np.uint64(level)))
            before.append(np.full(len(out[-1]), alone))         # a combination need not be the first that a pair shares
    keys, at = np.unique(np.concatenate(out), return_index=True)
    return keys, np.maximum(np.concatenate(before)[at], 0)


def signatures(rows: DataFrame, bounds: Bounds) -> DataFrame:
    """(key, rep, n, before) from rows (rep, n, tokens array<struct<df, h>>)."""
    kind = rows.schema["rep"].dataType.simpleString()

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            tokens = batch.column("tokens")
            flat, ends = tokens.flatten(), tokens.offsets.to_numpy() - tokens.offsets[0].as_py()
            all_df, all_h = flat.field("df").to_numpy(), flat.field("h").to_numpy().view(np.uint64)
            keys, before = [], []
            for n, low, high in zip(batch.column("n").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                df, h = all_df[low:high], all_h[low:high]
                order = np.lexsort((h, df))
                k, at = class_signatures(n, df[order], h[order], bounds)
                keys.append(k)
                before.append(at)
            owner = pa.array(np.repeat(np.arange(batch.num_rows), [len(k) for k in keys]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), batch.column("rep").take(owner), batch.column("n").take(owner),
                 pa.array(np.concatenate(before).astype(np.int64))], names=["key", "rep", "n", "before"])
        return step

    return map_batches(rows.select("rep", "n", "tokens"), make, f"key long, rep {kind}, n long, before long")


def can_link(percent: int, n: tuple, before: tuple):
    """Positional filter at the first signature that a pair shares: what stands before it is not shared."""
    most = F.least(F.col(n[0]) - F.col(before[0]), F.col(n[1]) - F.col(before[1]))
    return 100 * most >= percent * (F.col(n[0]) + F.col(n[1]) - most)


def sketch(s: np.ndarray) -> np.ndarray:
    """For each of ``64 * SKETCH`` residues whether an odd number of the set's tokens has it."""
    odd = np.bincount((s % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches_allow(percent: int, n: tuple, names: tuple):
    """Two sets that meet the threshold differ in at most (1 - t) / (1 + t) of their sizes' sum."""
    apart = F.bit_count(F.get(names[0], F.lit(0)).bitwiseXOR(F.get(names[1], F.lit(0))))
    for i in range(1, SKETCH):
        apart = apart + F.bit_count(F.get(names[0], F.lit(i)).bitwiseXOR(F.get(names[1], F.lit(i))))
    return (100 + percent) * apart <= (100 - percent) * (F.col(n[0]) + F.col(n[1]))


def families(index: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, rep, n, before, w, sketch) from the signatures (key, rep, n, before): one key for each pivot, ``w``
    signatures that the member has in it."""
    pivots = index.groupBy("key").agg(F.min_by("rep", F.xxhash64("rep")).alias("pivot"))
    joined = (index.join(pivots, "key").groupBy(F.col("pivot").alias("key"), "rep", "n")
              .agg(F.min("before").alias("before"), F.count("*").alias("w")))
    drawn = sets.select(F.col("doc_id").alias("rep"), "n", "sketch")
    return shared_table(joined.join(drawn, ["rep", "n"]).distinct(), "families")


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of ``rows`` rows, to be broadcast if they are few enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def verified(pairs: DataFrame, n_pairs: int, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, link) of pairs (a, b) of classes, by their whole sets (doc_id, tokens)."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("a_tokens"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("b_tokens"))
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return (left.join(small(pairs, n_pairs), "a").join(right, "b")
            .select("a", "b", common.alias("common"), (F.size("a_tokens") + F.size("b_tokens")).alias("both"))
            .select("a", "b", (100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).alias("link")))


def connected(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component of ``edges`` (a, b)."""
    sym = shared_table(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = sym.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label"))
    while True:
        near = sym.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = hooked.join(jump, "label").select("node", "was", F.least("label", "further").alias("label"))
        after, facts = counted_table(after, "labels", moved=F.count_if(F.col("label") != F.col("was")))
        labels = after.select("node", "label")
        if not facts["moved"]:
            return labels


def join_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id), one row per row of ``docs``."""
    bounds = Bounds(percent)
    first = shared_table(shingles(docs, words, "n_shingles long, key binary, tokens array<long>, shared long", lambda s: (
        len(s), set_key(s), s[: bounds.sent(len(s))].view(np.int64), bounds.shared(len(s)))), "first")
    member = first.select("doc_id", "n_shingles", "key")
    reps = member.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"))

    # 2. tokens that stand in one document only, and the classes that keep enough others
    sole = (first.select("doc_id", F.explode("tokens").alias("h")).where("doc_id is not null")
            .groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo = hi")
            .groupBy(F.col("lo").alias("own")).agg(F.count("*").alias("alone")))
    may = (first.select("doc_id", "key", F.size("tokens").alias("sent"), "shared").join(sole, F.col("doc_id") == F.col("own"), "left")
           .where(F.col("sent") - F.coalesce("alone", F.lit(0)) >= F.col("shared")).select("key").distinct())
    active, facts = counted_table(reps.join(may, "key").where("rep is not null").select(F.col("rep").alias("doc_id")).distinct(), "active")

    # 3. whole sets of these classes, and the frequencies of their tokens
    sets, facts = counted_table(
        shingles(id_text(docs).join(small(active, facts["n"]), "doc_id"), words, "n long, tokens array<long>, sketch array<long>",
                 lambda s: (len(s), s.view(np.int64), sketch(s))), "sets")
    tokens = sets.select(F.col("doc_id").alias("rep"), "n", F.explode("tokens").alias("h"))
    often = tokens.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    lists = tokens.join(often, "h").groupBy("rep", "n").agg(F.collect_list(F.struct("df", "h")).alias("tokens"))

    # 4. signatures held by several classes
    raw = shared_table(signatures(lists, bounds).distinct(), "signatures")
    held = raw.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo != hi").select("key")
    index = shared_table(raw.join(held, "key"), "index")
    paired, facts = counted_table(index.select(F.col("rep").alias("doc_id")).distinct(), "paired")

    # 5. rounds of verification
    comp = None
    if facts["n"]:
        own = sets.join(small(paired, facts["n"]), "doc_id")
        comp = link_rounds(families(index, own), paired, own, bounds, facts["n"])
    out = member.join(reps, "key", "left")
    if comp is None:
        label = F.col("rep")
    else:
        out, label = out.join(comp.withColumnRenamed("doc_id", "rep"), "rep", "left"), F.coalesce("label", "rep")
    own = F.col("key").isNull()
    return out.select("doc_id", "n_shingles", F.when(own, F.col("doc_id")).otherwise(F.col("rep")).alias("class_id"),
                      F.when(own, F.col("doc_id")).otherwise(label).alias("component_id"))


def link_rounds(index: DataFrame, active: DataFrame, sets: DataFrame, bounds: Bounds, n_active: int) -> DataFrame:
    """(doc_id, label) for all active classes, from the families of ``index``."""
    comp = active.select("doc_id", F.col("doc_id").alias("label"))
    other = ["rep", "n", "before", "sketch", "label"]
    tested, before, turn = None, None, 0
    while True:
        marked = index.join(comp.withColumnRenamed("doc_id", "rep"), "rep")
        open_keys = (marked.groupBy("key", "label").agg(F.count("*").alias("n"))
                     .groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"), F.count("*").alias("labels"))
                     .where("labels > 1"))
        open_keys, facts = counted_table(open_keys, "open", pairs=F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2))
        left = facts["pairs"] or 0
        if not left:
            return comp
        last = left <= ALL_PAIRS * n_active or (before is not None and 2 * left > before)
        members = marked.join(open_keys.select("key"), "key")
        partners = members
        if not last:        # some members of each family, drawn anew in each round
            draw = F.xxhash64("rep", F.lit(turn))
            partners = (members.groupBy("key", F.pmod(draw, F.lit(CENTRES)).alias("seat")).agg(F.min_by(F.struct(*other), draw).alias("c"))
                        .select("key", "c.*"))
        partners = partners.select("key", *[F.col(c).alias(f"o_{c}") for c in other])
        one = F.col("rep") < F.col("o_rep") if last else F.col("rep") != F.col("o_rep")
        pairs = (members.join(partners, "key").where(
            one & (F.col("label") != F.col("o_label")) & can_link(bounds.percent, ("n", "o_n"), ("before", "o_before"))
            & (100 * F.least("n", "o_n") >= bounds.percent * F.greatest("n", "o_n"))
            & sketches_allow(bounds.percent, ("n", "o_n"), ("sketch", "o_sketch")))
            .select(F.least("rep", "o_rep").alias("a"), F.greatest("rep", "o_rep").alias("b")).distinct())
        pairs, facts = counted_table(without(pairs, tested), "pairs")
        result = verified(pairs, facts["n"], sets, bounds.percent)
        links, facts = counted_table(result.where("link").select("a", "b").distinct(), "links")
        if facts["n"]:
            ends = links
            for side in ("a", "b"):
                ends = ends.join(comp.select(F.col("doc_id").alias(side), F.col("label").alias(f"{side}_label")), side)
            merged = connected(ends.select(F.col("a_label").alias("a"), F.col("b_label").alias("b")))
            comp = shared_table(comp.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
                                .select("doc_id", F.coalesce("to", "label").alias("label")), "components")
        if last:
            return comp
        tested = pairs if tested is None else tested.unionByName(pairs)
        before, turn = left, turn + 1


def without(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest id (rows of a null id stay)."""
    found = join_components(docs, words, percent)
    gone = found.where("component_id != doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
