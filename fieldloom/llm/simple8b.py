"""Token ids as Simple-8b words: files of segments that can be decoded with array operations."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import new_path
from .tokens import encoded

MAGIC = b"S8T1"
#: Ids in a block; a block starts with a new word, whose number is stored.
BLOCK = 1024
#: Ids of so many bits or more are escapes: a zero in their place, and position and id in a list.
ESCAPE_BITS = 30
#: How many ids a word holds by selector, and the bits of each (selectors 0 and 1: zeros).
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def _selectors(ids: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each place, the selector of a word that starts there.  room: ids up to the end of the block."""
    width = np.frexp(ids.astype(np.float64))[1].astype(np.int8)  # bits of each
    best = np.full(len(ids), len(COUNTS) - 1, np.int64)
    top, have = width, 1  # the widest id among the next `have`
    for s in range(len(COUNTS) - 2, -1, -1):
        while have < COUNTS[s]:
            step = min(have, int(COUNTS[s]) - have)
            top = np.maximum(top, np.concatenate((top[step:], np.zeros(min(step, len(top)), np.int8))))[: len(ids)]
            have += step
        best[(top <= WIDTHS[s]) & (room >= COUNTS[s])] = s
    return best


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words, the number of the first word of each block, and places and ids of the escapes."""
    ids = ids.astype(np.uint32)
    places = np.flatnonzero(ids >= (1 << ESCAPE_BITS))
    escaped = ids[places]
    ids[places] = 0
    n = len(ids)
    blocks = -(-n // BLOCK)
    start = np.arange(blocks) * BLOCK
    end = np.minimum(start + BLOCK, n)
    room = np.repeat(end, end - start) - np.arange(n)
    selector = _selectors(ids, room)
    cursor, alive, at, owner = start.copy(), np.arange(blocks), [], []
    while len(alive):  # all blocks side by side, a word of each at a time
        now = cursor[alive]
        at.append(now)
        owner.append(alive)
        cursor[alive] = now + COUNTS[selector[now]]
        alive = alive[cursor[alive] < end[alive]]
    at = np.sort(np.concatenate(at)) if at else np.zeros(0, np.int64)
    first = np.searchsorted(at, start)
    chosen = selector[at]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(2, len(COUNTS)):
        k = np.flatnonzero(chosen == s)
        for j in range(COUNTS[s] if len(k) else 0):
            words[k] |= ids[at[k] + j].astype(np.uint64) << np.uint64(WIDTHS[s] * j)
    return words, first, places, escaped


def unpack(words: np.ndarray, places: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint32)
    for s in range(2, len(COUNTS)):
        k = np.flatnonzero(chosen == s)
        for j in range(COUNTS[s] if len(k) else 0):
            out[at[k] + j] = (words[k] >> np.uint64(WIDTHS[s] * j)) & np.uint64((1 << int(WIDTHS[s])) - 1)
    out[places] = escaped
    return out


def segment(docs: np.ndarray, missing: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment: whole documents' ids with their doc_ids (missing: those without) and sizes."""
    words, first, places, escaped = pack(ids)
    head = np.array([len(docs), len(ids), len(words), len(first), len(places)], "<i8")
    parts = (head, docs.astype("<i8"), missing.astype("u1"), sizes.astype("<i8"), first.astype("<i8"), words.astype("<u8"), places.astype("<i8"), escaped.astype("<u4"))
    return MAGIC + b"".join(x.tobytes() for x in parts)


class Segment:
    """A segment read from its bytes; ids() decodes all of it, block(i) one block."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of token ids")
        at = 4

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(data, kind, n, at)
            at += x.nbytes
            return x

        n_docs, self.n_ids, n_words, n_blocks, n_escapes = take("<i8", 5).tolist()
        self.docs, self.missing, self.sizes = take("<i8", n_docs), take("u1", n_docs).astype(bool), take("<i8", n_docs)
        self.first, self.words = take("<i8", n_blocks), take("<u8", n_words)
        self.places, self.escaped = take("<i8", n_escapes), take("<u4", n_escapes)

    def ids(self) -> np.ndarray:
        return unpack(self.words, self.places, self.escaped)

    def block(self, i: int) -> np.ndarray:
        a = self.first[i]
        b = self.first[i + 1] if i + 1 < len(self.first) else len(self.words)
        x, y = np.searchsorted(self.places, [i * BLOCK, (i + 1) * BLOCK])
        return unpack(self.words[a:b], self.places[x:y] - i * BLOCK, self.escaped[x:y])


SEGMENTS = "part int, number int, before long, n_ids long, segment binary"


def _segments(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    task, number, before = TaskContext.get().partitionId(), 0, 0
    for part, ids, sizes in encoded(batches, path, end_id, pieces=600_000, limit=8 << 20):
        docs = part.column("doc_id")
        data = segment(docs.fill_null(0).to_numpy(zero_copy_only=False), docs.is_null().to_numpy(zero_copy_only=False), sizes, ids)
        yield pa.record_batch([pa.array([task], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([data], pa.binary())], names=["part", "number", "before", "n_ids", "segment"])
        number += 1
        before += len(ids)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Write the ids of every whole text, end_id after each, in ascending doc_id order.

    path becomes a folder of files in that order, through Spark's own writer (any store, safe when tasks are
    run again).  A row holds a segment: whole documents' ids as Simple-8b words with selectors, per-block word
    numbers and escapes, behind a header.  Documents are dealt by ranges of doc_id (rows that repeat one, by
    their text too), so that one doc_id with very many rows doesn't fall to one task.  A null text is empty, a
    null doc_id comes first; other columns aren't read.  Empty docs: no segments.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    dealt = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    dealt.mapInArrow(lambda it: _segments(it, tokenizer, end_id), SEGMENTS).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            s = Segment(batch.column("segment")[i].as_buffer().to_pybytes())
            ids = s.ids().astype("<u4")
            ends = np.cumsum(s.sizes)
            begins = ends - s.sizes
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
            start = begins + batch.column("start")[i].as_py()
            yield pa.record_batch([pa.array(s.docs, pa.int64(), mask=s.missing), pa.array(start), pa.array(s.sizes), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            s = Segment(batch.column("segment")[i].as_buffer().to_pybytes())
            cuts = np.concatenate(([0], np.cumsum(s.sizes))).astype(np.int32)
            yield pa.record_batch([pa.array(s.docs, pa.int64(), mask=s.missing), pa.ListArray.from_arrays(pa.array(cuts), pa.array(s.ids().astype(np.int64)))], names=["doc_id", "ids"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids (array of longs, the end id included) of every document in the folder."""
    return spark.read.schema(SEGMENTS).parquet(path).mapInArrow(_ids, "doc_id long, ids array<long>")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, decoded from the files.

    Only the totals of the files (one row for each) are put in order in one place.
    """
    found = spark.read.schema(SEGMENTS).parquet(path)
    totals = found.groupBy("part").agg(F.sum("n_ids").alias("n"))
    offsets = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    placed = found.join(F.broadcast(offsets), "part")  # broadcast: a row for each file
    placed = placed.select("segment", (F.col("before") + F.col("offset")).alias("start"))
    return placed.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write the ids of docs (to a new folder beside Spark's checkpoints, if no path is given) and read the index back."""
    path = path or new_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer, end_id)
    return read_index(docs.sparkSession, path)
