"""Token-id files: one zstandard frame per document under a shared, trained dictionary.

``write_tokens(docs, path, tokenizer_json)`` encodes every document, appends the
end id and writes three Parquet tables under ``path``:

* ``dictionary`` - one row: hash and bytes of the dictionary, width of an id, end id;
* ``segments``   - rows of at most about ``SEGMENT_BYTES``: the frames of consecutive
  documents in one binary, an offset for each document, and the dictionary's hash;
* ``shards``     - the number of ids before each shard (a range partition of ``doc_id``).

Documents stand in ascending ``doc_id`` order (null first, equal ids by a hash
of the text).  ``read_tokens`` gives them all back, ``read_document`` opens only
the segments whose id range holds the document and only its own frame.

The dictionary is trained on ids of at most ``SAMPLE_DOCS`` documents of at most
``SAMPLE_BYTES`` bytes, chosen by a hash of the id; a corpus too small to train
on gets the sample itself as raw dictionary content.  Every document is encoded whole.

The tokenizer library encodes each distinct run of "white space, then letters" or "white
space, then a word" of a block of documents once.  A pre-token never reaches from a word into
the white space after it, nor from letters into another sign, so these runs never cut one, and
their ids put together are those of the whole text.

Defined cases: null text = empty text = the end id alone; repeated rows are kept;
an empty table gives empty segment and shard tables; extra columns are dropped.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trialframe.llm.bpe import Numbering, gather
from trialframe.llm.common import id_text, map_batches, slices

SAMPLE_DOCS, SAMPLE_BYTES = 500, 16_384
DICTIONARY_BYTES, LEVEL = 65_536, 3
SEGMENT_BYTES, SEGMENT_DOCS = 1 << 20, 2_000
RUNS_KEPT, OFTEN = 300_000, 3     # distinct runs remembered before the rare ones are forgotten
# Letters of Latin blocks, and Unicode's White_Space characters.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"       # some that are letters in every version
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACES = frozenset(re.findall(f"[{SPACE}]", "".join(map(chr, range(0x3001)))))


class RunEncoder:
    """Ids of whole texts through a tokenizer file, each distinct run encoded once."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_json)
        self.split = re.compile(f"[{SPACE}]*[{LETTERS}]+|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]
        # a special token between runs keeps them apart in one call
        self.fence = next(((i, t.content) for i, t in added.items()
                           if t.special and not (t.lstrip or t.rstrip or t.single_word) and not has_border(t.content)), None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(max(vocabulary.values(), default=-1) + 1, dtype=np.int64)      # a character of an entry is a byte
        self.lengths[list(vocabulary.values())] = [len(entry) for entry in vocabulary]
        self.reset()

    @property
    def width(self) -> int:
        return 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    def reset(self) -> None:
        self.runs = Numbering()
        self.flat = np.zeros(0, dtype=np.uint32)
        self.starts = self.counts = self.times = np.zeros(0, dtype=np.int64)

    def thin(self) -> None:
        """Forget the runs that came up less than ``OFTEN`` times."""
        keep = np.flatnonzero(self.times >= OFTEN)[-RUNS_KEPT // 2:]
        words = self.runs.since(0)
        self.runs = Numbering([words[i] for i in keep.tolist()])
        self.flat = gather(self.flat, self.starts, self.counts, keep)
        self.counts, self.times = self.counts[keep], self.times[keep]
        self.starts = np.cumsum(self.counts) - self.counts

    def apart(self, runs: list[str]) -> list[np.ndarray]:
        """Ids of each run; strings of special tokens in it are ordinary text."""
        self.tokenizer.encode_special_tokens = True
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)]

    def fenced(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs, and how many each has; no run holds a special token's string."""
        number, fence = self.fence
        self.tokenizer.encode_special_tokens = False
        texts = [fence.join(runs[i:i + 200]) + fence for i in range(0, len(runs), 200)]
        ids = np.concatenate([np.array(e.ids, dtype=np.uint32)
                              for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(ids == number)
        if len(ends) != len(runs):
            raise ValueError("the special token does not keep runs apart")
        return ids[ids != number], np.diff(np.append(-1, ends)) - 1

    def joined(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of all runs, and how many each has, for runs that begin with white space and end without it: they stay
        apart by themselves and are cut where the tokens' bytes fill a run's.  None where no token ends there."""
        self.tokenizer.encode_special_tokens = True
        texts = ["".join(runs[i:i + 200]) for i in range(0, len(runs), 200)]
        ids = np.concatenate([np.array(e.ids, dtype=np.uint32)
                              for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        if not len(ids) or ids.max() >= len(self.lengths):
            return None
        ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum([len(run.encode()) for run in runs])
        if ends[-1] != wanted[-1]:
            return None
        at = np.searchsorted(ends, wanted)
        return (ids, np.diff(np.append(-1, at))) if (ends[at] == wanted).all() else None

    def ids_of(self, runs: list[str], led: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs, and how many each has; ``led`` runs begin with white space and end without it."""
        text = "".join(runs)
        special = any(t in text for t in self.added)
        got = self.joined(runs) if led and not special else None
        if got is None and (self.fence is None or special):
            ids = self.apart(runs)
            return np.concatenate(ids), np.array([len(x) for x in ids], dtype=np.int64)
        return got or self.fenced(runs)

    def learn(self) -> None:
        fresh, known = self.runs.since(len(self.counts)), len(self.counts)
        flats, base = [self.flat], len(self.flat)
        starts, counts = (np.append(x, np.zeros(len(fresh), dtype=np.int64)) for x in (self.starts, self.counts))
        for i in range(0, len(fresh), 20_000):
            part = fresh[i:i + 20_000]
            is_led = np.array([run[0] in SPACES and run[-1] not in SPACES for run in part])
            for led in (True, False):
                at = np.flatnonzero(is_led == led)
                if len(at):
                    ids, n = self.ids_of([part[k] for k in at.tolist()], led)
                    counts[known + i + at], starts[known + i + at] = n, base + np.cumsum(n) - n
                    flats.append(ids)
                    base += len(ids)
        self.flat, self.starts, self.counts = np.concatenate(flats), starts, counts

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.runs) > RUNS_KEPT:
            self.thin()
        numbers = [self.runs.numbers_of(self.split(text)) for text in texts]
        self.learn()
        self.times = np.append(self.times, np.zeros(len(self.runs) - len(self.times), dtype=np.int64))
        if numbers:
            self.times += np.bincount(np.concatenate(numbers), minlength=len(self.times))
        for n in numbers:
            yield gather(self.flat, self.starts, self.counts, n)


@functools.cache
def shared_encoder(tokenizer_json: str) -> RunEncoder:
    """One encoder for all tasks of a worker process."""
    return RunEncoder(tokenizer_json)


def has_border(text: str) -> bool:
    """Whether a beginning of ``text`` is also its end."""
    return any(text.startswith(text[k:]) for k in range(1, len(text)))


def train_dictionary(docs: DataFrame, tokenizer_json: str, end_id: int) -> bytes:
    """Dictionary content trained on the serialized ids of a bounded sample."""
    texts = (id_text(docs).where(F.octet_length("text") <= SAMPLE_BYTES)
             .select(F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"), "text"))
    chosen = texts.select("h", "t").distinct().orderBy("h", "t").limit(SAMPLE_DOCS)       # tasks send hashes, not texts
    rows = texts.join(F.broadcast(chosen), ["h", "t"]).groupBy("h", "t").agg(F.first("text").alias("text")).collect()
    encoder = RunEncoder(tokenizer_json)
    samples = [serialize(x, end_id, encoder.width) for x in encoder.encode([r.text for r in sorted(rows)])]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:      # too little to train on
        return b"".join(samples)[-DICTIONARY_BYTES:]


def serialize(ids: np.ndarray, end_id: int, width: int) -> bytes:
    return np.append(ids, np.uint32(end_id)).astype(f"<u{width}").tobytes()


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    d = zstandard.ZstdCompressionDict(dictionary)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d)


def decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def dictionary_hash(dictionary: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(dictionary)


def write_tokens(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = 2) -> str:
    """Write the token files of ``docs`` under ``path``; returns ``path``."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    dictionary = train_dictionary(docs, tokenizer_json, end_id)
    checksum, width = dictionary_hash(dictionary), RunEncoder(tokenizer_json).width
    spark.createDataFrame([(checksum, dictionary, width, end_id)],
                          "dict_hash string, dictionary binary, id_bytes int, end_id long").coalesce(1).write.parquet(f"{path}/dictionary")

    def make():
        encoder, pack = shared_encoder(tokenizer_json), compressor(dictionary).compress
        shard, state = TaskContext.get().partitionId(), {"segment": 0, "start": 0}

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch):
                yield from segments_of(part)

        def segments_of(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            held: list[tuple[int, bytes]] = []
            base = size = 0

            def flush(stop: int) -> pa.RecordBatch:
                counts = [n for n, _ in held]
                starts = (state["start"] + np.cumsum(counts) - counts).astype(np.int64)
                offsets = np.cumsum([0, *(len(f) for _, f in held)]).astype(np.int64)
                ids = part.column("doc_id").slice(base, stop - base)
                out = pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([state["segment"]], pa.int32()), pa.array([checksum]),
                     pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                     *(pa.array([x], pa.list_(pa.int64())) for x in (starts, counts, offsets)),
                     pa.array([b"".join(f for _, f in held)], pa.binary())],
                    names=["shard", "segment", "dict_hash", "doc_ids", "starts", "counts", "offsets", "frames"])
                state["segment"] += 1
                state["start"] += sum(counts)
                held.clear()
                return out

            for i, ids in enumerate(encoder.encode(part.column("text").to_pylist())):
                held.append((len(ids) + 1, pack(serialize(ids, end_id, width))))
                size += len(held[-1][1])
                if size >= SEGMENT_BYTES or len(held) >= SEGMENT_DOCS:
                    yield flush(i + 1)
                    base, size = i + 1, 0
            if held:
                yield flush(part.num_rows)
        return step

    ordered = (id_text(docs).withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h")
               .sortWithinPartitions("doc_id", "h").select("doc_id", "text"))
    segments = map_batches(ordered, make, f"shard int, segment int, dict_hash string, doc_ids array<{kind}>, "
                           "starts array<long>, counts array<long>, offsets array<long>, frames binary")
    (segments.withColumn("first_id", F.array_min("doc_ids")).withColumn("last_id", F.array_max("doc_ids"))
     .write.parquet(f"{path}/segments"))
    totals = (spark.read.parquet(f"{path}/segments")
              .select("shard", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
              .groupBy("shard").agg(F.sum("n").alias("n")))       # one row a shard
    (totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("ids_before"))
     .write.parquet(f"{path}/shards"))
    return path


def _open(spark: SparkSession, path: str, segments: DataFrame, wanted=None) -> DataFrame:
    """Rows of the documents in ``segments``; with ``wanted``, only the frames of that id are opened."""
    meta = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, width, checksum = bytes(meta.dictionary), meta.id_bytes, meta.dict_hash
    if dictionary_hash(dictionary) != checksum:
        raise ValueError("the dictionary does not match its hash")
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    rows = segments.join(spark.read.parquet(f"{path}/shards"), "shard").select(
        "dict_hash", "ids_before", "doc_ids", "starts", "counts", "offsets", "frames")

    def make():
        unpack = decompressor(dictionary).decompress

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names if name != "frames"}
                if row["dict_hash"] != checksum:
                    raise ValueError("a segment was written with another dictionary")
                frames, cuts = batch.column("frames")[i].as_buffer(), row["offsets"]
                keep = [k for k, x in enumerate(row["doc_ids"]) if wanted is None or x == wanted]
                ids = [np.frombuffer(unpack(frames[cuts[k]:cuts[k + 1]]), dtype=f"<u{width}").astype("<u4").tobytes() for k in keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"][k] for k in keep], batch.schema.field("doc_ids").type.value_type),
                     pa.array([row["ids_before"] + row["starts"][k] for k in keep], pa.int64()),
                     pa.array([row["counts"][k] for k in keep], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])
        return step

    return map_batches(rows, make, f"doc_id {kind}, start long, n_tokens long, ids binary")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start long, n_tokens long, ids binary of little-endian unsigned 32-bit) of all documents."""
    return _open(spark, path, spark.read.parquet(f"{path}/segments"))


def read_document(spark: SparkSession, path: str, doc_id) -> DataFrame:
    """The same columns for one document id: segments are pruned by their id range, other frames stay closed."""
    segments = spark.read.parquet(f"{path}/segments").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    return _open(spark, path, segments, wanted=doc_id)
