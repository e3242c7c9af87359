"""Fill-in-middle transformation with content-defined chunks and memoized boundary summaries.

``transform(docs)`` cuts each text at two token places, chosen by a hash of the id, and puts the pieces in
prefix-suffix-middle (psm) or suffix-prefix-middle (spm) order, or leaves it plain; ``restore(rows)`` gives
the texts back.  Tokens are runs of ASCII letters and single other code points.

1. A rolling hash over ``WINDOW`` bytes cuts a text into chunks wherever its lowest bits are all set, and
   after ``MAX_CHUNK`` bytes.  The hash sees only bytes of the text itself, so passages that documents share fall into the same chunks.
2. Each distinct chunk is summarized once per task: how many tokens start in it when no letter stands
   before it, whether it begins and ends with a letter, and its code points.  Summaries are looked up by the
   chunk's bytes, so equal contents are verified, not assumed.
3. A token that runs across a border starts in one chunk only: a chunk that begins with a letter after one that ends
   with a letter has one start less.  Running sums over a document's summaries give its tokens and the chunks that hold
   the two cuts; only those two are read again for the places inside.

Defined cases: a null text is empty; empty texts and texts that hold a marker are plain; a null id hashes
as the text ''; repeated rows each return; an empty table gives no rows; extra columns pass by.  A text of any length is
cut in one piece; texts are worked on in slices of about 4 MB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialframe.llm.common import id_text, map_batches, slices, unused

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_SHARE, SPM_SHARE = 10, 20         # per cent of all texts, of the transformed ones
WINDOW = 16
MASK = (1 << 9) - 1                     # a chunk in 512 places
MAX_CHUNK = 8192
REMEMBERED = 64 << 20                   # bytes of chunks that a task remembers before it starts afresh

GEAR = np.frombuffer(hashlib.shake_256(b"gear").digest(1024), dtype="<u4")      # a number for each byte
FACTOR = 0x9E3779B1
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_HEAD = np.ones(256, dtype=bool)        # bytes that begin a code point
_HEAD[0x80:0xC0] = False


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes up to each byte (fewer at the beginning)."""
    h, width = GEAR[data], 1
    while width < WINDOW:               # sums of 1, 2, 4, ... terms of a geometric sum
        more = h.copy()
        more[width:] += h[:-width] * np.uint32(pow(FACTOR, width, 1 << 32)) if width < len(h) else np.uint32(0)
        h, width = more, 2 * width
    return h


def chunk_ends(data: np.ndarray, text_ends: np.ndarray) -> np.ndarray:
    """Ascending places where chunks end; each text's end is one, and no chunk looks into the text before."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    cut = np.flatnonzero(((rolling_hash(data) >> np.uint32(16)) & np.uint32(MASK)) == MASK) + 1
    starts = np.append(0, text_ends[:-1])
    own = np.searchsorted(text_ends, cut - 1, side="right")
    cut = cut[cut - starts[np.minimum(own, len(starts) - 1)] >= WINDOW]
    ends = np.union1d(cut, text_ends[text_ends > 0])
    gaps = np.diff(np.append(0, ends))
    long = np.flatnonzero(gaps > MAX_CHUNK)
    if len(long):
        begin = ends[long] - gaps[long]
        ends = np.union1d(ends, np.concatenate([np.arange(b + MAX_CHUNK, e, MAX_CHUNK) for b, e in zip(begin.tolist(), ends[long].tolist())]))
    return ends.astype(np.int64)


def token_starts(data: np.ndarray) -> np.ndarray:
    """Whether a token starts at each byte, nothing standing before the first."""
    letter = _LETTER[data]
    after = np.zeros(len(data), dtype=bool)
    after[1:] = letter[:-1]
    return np.where(letter, ~after, _HEAD[data])


class Summaries:
    """By a chunk's bytes: (token starts, begins with a letter, ends with a letter, code points)."""

    def __init__(self):
        self.reset()
        self.asked = self.made = 0

    def reset(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.table = np.zeros((0, 4), dtype=np.int64)
        self.held = 0

    def of(self, chunks: list[bytes]) -> np.ndarray:
        if self.held > REMEMBERED:
            self.reset()
        known = len(self.rows)
        places = np.fromiter((self.rows.setdefault(c, len(self.rows)) for c in chunks), dtype=np.int64, count=len(chunks))
        fresh, at = np.unique(places, return_index=True)
        new = [chunks[i] for i in at[fresh >= known].tolist()]
        if new:
            self.table = np.concatenate([self.table, self.summarize(new)])
            self.held += sum(map(len, new))
        self.asked, self.made = self.asked + len(chunks), self.made + len(new)
        return self.table[places]

    @staticmethod
    def summarize(chunks: list[bytes]) -> np.ndarray:
        data = np.frombuffer(b"".join(chunks), dtype=np.uint8)
        ends = np.cumsum([len(c) for c in chunks])
        begins = np.append(0, ends[:-1])
        starts = token_starts(data)
        starts[begins] = _LETTER[data[begins]] | _HEAD[data[begins]]        # no letter before a chunk
        return np.stack([np.add.reduceat(starts, begins, dtype=np.int64), _LETTER[data[begins]], _LETTER[data[ends - 1]],
                         np.add.reduceat(_HEAD[data], begins, dtype=np.int64)], axis=1)


def draws(doc_id) -> tuple[int, int, int, int]:
    h = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    return tuple(int(h[8 * i: 8 * i + 8], 16) for i in range(4))


class Cutter:
    """Token counts of texts and the byte and code point places of token cuts."""

    def __init__(self):
        self.summaries = Summaries()

    def cuts(self, texts: list[bytes], choose) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """For each text its tokens ``n`` and, for each k of ``choose(i, n)``, where its first k tokens end
        (bytes, code points)."""
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        text_ends = np.cumsum([len(t) for t in texts])
        ends = chunk_ends(data, text_ends)
        begins = np.append(0, ends)[:-1]
        whole = memoryview(data)
        info = self.summaries.of([whole[a:z].tobytes() for a, z in zip(begins.tolist(), ends.tolist())])
        last = np.searchsorted(ends, text_ends, side="right")
        first = np.append(0, last[:-1])
        joined = np.zeros(len(ends), dtype=np.int64)
        if len(ends) > 1:
            joined[1:] = info[1:, 1] & info[:-1, 2]
        joined[first[first < last]] = 0                     # a text's first chunk follows no letter
        starts = info[:, 0] - joined
        upto, points = np.append(0, np.cumsum(starts)), np.append(0, np.cumsum(info[:, 3]))
        for i in range(len(texts)):
            a, z = int(first[i]), int(last[i])
            n, places = int(upto[z] - upto[a]), []
            begin = int(text_ends[i]) - len(texts[i])
            for k in choose(i, n):
                if k >= n:
                    places.append((len(texts[i]), int(points[z] - points[a])))
                    continue
                c = int(np.searchsorted(upto, upto[a] + k, side="right")) - 1       # the chunk in which token k starts
                lo, hi = int(begins[c]), int(ends[c])
                inside = token_starts(data[lo:hi])
                inside[0] = _LETTER[data[lo]] and not joined[c] or bool(_HEAD[data[lo]]) and not _LETTER[data[lo]]
                at = int(np.flatnonzero(inside)[int(upto[a] + k - upto[c])])
                places.append((lo + at - begin, int(points[c] - points[a]) + int(_HEAD[data[lo:lo + at]].sum())))
            yield n, places


def form_of(text: str, draw: tuple[int, int, int, int]) -> str:
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or draw[2] % 100 >= 100 - PLAIN_SHARE:
        return "plain"
    return "spm" if draw[3] % 100 < SPM_SHARE else "psm"


def transform(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        cutter = Cutter()

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                texts, ids = part.column("text").to_pylist(), part.column("doc_id").to_pylist()
                data, drawn = [t.encode("utf-8", "surrogatepass") for t in texts], [draws(i) for i in ids]
                rows = []
                found = cutter.cuts(data, lambda i, n: sorted((drawn[i][0] % (n + 1), drawn[i][1] % (n + 1))))
                for text, raw, draw, (n, ((a, a_points), (z, z_points))) in zip(texts, data, drawn, found, strict=True):
                    form = form_of(text, draw)
                    prefix, middle, suffix = raw[:a], raw[a:z], raw[z:]
                    out = (raw if form == "plain" else b"".join((b"<S>", suffix, b"<P>", prefix, b"<M>", middle)) if form == "spm"
                           else b"".join((b"<P>", prefix, b"<S>", suffix, b"<M>", middle)))
                    rows.append((n, form, *((None, None) if form == "plain" else (a_points, z_points - a_points)), out))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, _KINDS, strict=True))],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
        return step

    found = map_batches(id_text(docs), make, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return found.withColumn("output", F.col("output").cast("string"))


_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())


def restore(rows: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``rows`` with ``restored``, the text rebuilt from output and form by column expressions: the pieces hold no marker
    and no marker can begin inside another, so a marker's first place after the leading one is its own."""
    name = unused("_fim", rows)
    second = F.when(F.col(form) == "psm", F.instr(f"{name}0", SUFFIX)).otherwise(F.instr(f"{name}0", PREFIX))
    steps = rows.withColumn(f"{name}0", F.substr(output, F.lit(len(PREFIX) + 1))).withColumn(f"{name}1", second)
    steps = (steps.withColumn(f"{name}left", F.substr(f"{name}0", F.lit(1), F.col(f"{name}1") - 1))
             .withColumn(f"{name}2", F.substr(f"{name}0", F.col(f"{name}1") + len(SUFFIX)))
             .withColumn(f"{name}3", F.instr(f"{name}2", MIDDLE)))
    left, right = F.col(f"{name}left"), F.substr(f"{name}2", F.lit(1), F.col(f"{name}3") - 1)
    middle = F.substr(f"{name}2", F.col(f"{name}3") + len(MIDDLE))
    text = (F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", F.concat(left, middle, right))
            .otherwise(F.concat(right, middle, left)))
    return steps.select(*[F.col(c) for c in rows.columns], text.alias("restored"))
