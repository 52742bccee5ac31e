"""Packing documents into sequences by minimum bin slack."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written
from .tokens import encoded
from .words import slices, trim


def slack(total: int, capacity: int) -> int:
    """Padding of a sequence: up to the capacity, none at a power of two."""
    return 0 if total & (total - 1) == 0 else capacity - total


def fill(left: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of the lengths left (length: how many) that fills a window best, with the longest among them.

    A bitset of the sums that can be reached grows by one length at a time (as many copies as are left, in
    binary parts); the chosen sum is traced back to how many of each length it takes.  Best: the largest sum,
    or a power of two (no padding) where the largest would be padded.
    """
    longest = max(left)
    room = capacity - longest
    window = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in sorted(left, key=lambda k: (-left[k], -k)):  # so that lengths of which there are many are used up along the way
        copies = min(left[length] - (length == longest), room // length)
        part = 1
        while copies > 0:
            part = min(part, copies)
            steps.append((reached, length, part))
            reached |= (reached << (length * part)) & window
            copies -= part
            part *= 2
        if reached >> room & 1:
            break
    total = reached.bit_length() - 1
    if slack(longest + total, capacity):
        power = 1 << (capacity.bit_length() - 1)
        while power >= longest:
            if power <= capacity and reached >> (power - longest) & 1:
                total = power - longest
                break
            power //= 2
    taken = {longest: 1}
    for before, length, part in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + part
            total -= length * part
    return taken


class Plan:
    """Where each piece goes, by its length and its rank among the pieces of that length.

    Each pattern (a multiset of lengths) repeats as often as its lengths last, so that the work depends on how many
    different lengths there are (the capacity at most), not on how many pieces.  Where no multiset fills a
    window, the piece of which most are left is cut: its start fills the window, and its end is a piece of a class
    of its own that is packed later.  Only the last window is padded.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.sequences = 0
        #: class: first ranks, and (copies in a sequence, first sequence, offset, length there, (class, rank) of what is cut off)
        self.firsts: dict[int, list[int]] = {}
        self.entries: dict[int, list[tuple]] = {}
        self.left = {k: [[k, v]] for k, v in counts.items() if v}  # length: [class, pieces left] ...
        self.seen: dict[int, int] = {}
        self.classes = capacity
        while self.left:
            self._pattern()

    def _pattern(self) -> None:
        taken = fill({k: sum(n for _, n in v) for k, v in self.left.items()}, self.capacity)
        parts, total = [], 0
        for length, many in sorted(taken.items(), reverse=True):
            total += length * many
            for pool in sorted(self.left[length], key=lambda x: -x[1]):
                use = min(many, pool[1])
                parts.append((pool, length, use))
                many -= use
                if not many:
                    break
        times = min(pool[1] // use for pool, _, use in parts)
        donor = None
        if slack(total, self.capacity):
            used = {id(pool): use for pool, _, use in parts}
            spare = [(pool[1] - used.get(id(pool), 0), length, pool) for length, pools in self.left.items() for pool in pools]
            rest, length, donor = max(spare, key=lambda x: x[:2])
            if rest:
                times = min(times, donor[1] // (used.get(id(donor), 0) + 1))
            else:
                donor = None
        offset = 0
        for pool, size, use in parts:
            self._put(pool, times * use, (use, self.sequences, offset, size, None))
            offset += size * use
        if donor is not None:
            self.classes += 1
            self._put(donor, times, (1, self.sequences, offset, self.capacity - total, self.classes))
            self.left.setdefault(length - (self.capacity - total), []).append([self.classes, times])
        self.sequences += times
        self.left = {k: pools for k, v in self.left.items() if (pools := [x for x in v if x[1]])}

    def _put(self, pool: list[int], n: int, entry: tuple) -> None:
        name = pool[0]
        self.firsts.setdefault(name, []).append(self.seen.get(name, 0))
        self.entries.setdefault(name, []).append(entry)
        self.seen[name] = self.seen.get(name, 0) + n
        pool[1] -= n

    def places(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of each part of a piece."""
        name, at = length, 0
        while name is not None:
            i = bisect_right(self.firsts[name], rank) - 1
            copies, sequence, offset, size, tail = self.entries[name][i]
            rank -= self.firsts[name][i]
            yield at, size, sequence + rank // copies, offset + rank % copies * size
            name, at = tail, at + size


#: Bytes of text, and of ids, handled at once.
SLICE = 1 << 20
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    for part, ids, sizes in encoded(batches, path, end_id, limit=SLICE):
        ids = ids.astype("<u4")
        many = -(-sizes // capacity)
        row = np.repeat(np.arange(len(sizes)), many)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * capacity
        length = np.minimum(sizes[row] - start, capacity)
        cuts = np.concatenate(([0], np.cumsum(length) * 4)).astype(np.int64)  # pieces follow one another
        data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(cuts), pa.py_buffer(ids)]).cast(pa.binary())
        yield pa.record_batch([part.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(sizes[row]), data], names=["doc_id", "start", "length", "doc_tokens", "ids"])


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (little-endian 32-bit) of every piece of every document.

    A document is cut only where it is longer than the capacity: full pieces first, then what remains.
    A null text is empty and gives the end id alone.
    """
    return docs.select("doc_id", "text").mapInArrow(lambda it: _pieces(it, tokenizer, end_id, capacity), PIECES)


def _ranked(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """Adds the file and the rank of each piece among those of its length in the file."""
    seen = np.zeros(capacity + 1, np.int64)
    task = TaskContext.get().partitionId()
    for batch in batches:
        length = batch.column("length").to_numpy()
        order = np.argsort(length, kind="stable")
        ordered = length[order]
        begins = np.searchsorted(ordered, ordered)  # of each one's own length
        rank = np.empty(len(length), np.int64)
        rank[order] = np.arange(len(length)) - begins + seen[ordered]
        seen += np.bincount(length, minlength=capacity + 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), task, np.int32)), pa.array(rank)], names=[*batch.schema.names, "_pack_file", "_pack_rank"])


def _placed(batches: Iterator[pa.RecordBatch], chosen: Plan) -> Iterator[pa.RecordBatch]:
    trim()
    for batch in batches:
        for part in slices(batch, "ids", SLICE):
            ids = part.column("ids")
            rows, starts, sizes, numbers, offsets, data = [], [], [], [], [], []
            for i, (start, length, rank, before) in enumerate(zip(*(part.column(c).to_pylist() for c in ("start", "length", "_pack_rank", "_pack_before")))):
                for at, size, number, offset in chosen.places(length, rank + before):
                    rows.append(i)
                    starts.append(start + at)
                    sizes.append(size)
                    numbers.append(number)
                    offsets.append(offset)
                    data.append(ids[i].as_py() if size == length else ids[i].as_py()[4 * at : 4 * (at + size)])
            new = {"start": pa.array(starts, pa.int64()), "length": pa.array(sizes, pa.int64()), "ids": pa.array(data, pa.binary())}
            take = pa.array(rows, pa.int64())
            names = [n for n in part.schema.names if not n.startswith("_pack_")]
            yield pa.RecordBatch.from_arrays([*(new[n] if n in new else part.column(n).take(take) for n in names), pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())], names=[*names, "sequence_id", "offset"])


#: Rows of the table of counts by file and length up to which it is broadcast (some 70 MB); beyond, it is shuffled.
BROADCAST_ROWS = 500_000


def pack(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """parts (as pieces() gives them; other columns stay) with sequence_id and offset in the sequence.

    A sequence holds capacity ids at most and its parts leave no gap.  The counts of each length (`capacity`
    numbers at most, however many pieces there are) make the plan on the driver.  The place of a piece follows
    from its rank among those of its length: its rank in its file, plus how many earlier files have, so that
    no length is gathered in one task.  A piece may be cut once more, and then is in several rows.
    Empty parts: an empty result.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return _pack(parts.mapInArrow(lambda it: _ranked(it, capacity), f"{kinds}, _pack_file int, _pack_rank long"), kinds, capacity)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048) -> DataFrame:
    """pack(pieces(docs)), with one Python step less."""
    ranked = docs.select("doc_id", "text").mapInArrow(lambda it: _ranked(_pieces(it, tokenizer, end_id, capacity), capacity), f"{PIECES}, _pack_file int, _pack_rank long")
    return _pack(ranked, PIECES, capacity)


def _pack(ranked: DataFrame, kinds: str, capacity: int) -> DataFrame:
    columns = [c for c in ranked.columns if not c.startswith("_pack_")]
    table, _ = written(ranked, "pieces")
    tally = table.groupBy("_pack_file", "length").agg(F.count("*").alias("n"))
    tally, _ = written(tally, "tally")
    counts = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row a length
    chosen = Plan(counts, capacity)
    before = tally.select("_pack_file", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("_pack_file")) - F.col("n")).alias("_pack_before"))
    if tally.count() <= BROADCAST_ROWS:
        before = F.broadcast(before)
    ranked = table.join(before, ["_pack_file", "length"]).select(*columns, "_pack_rank", "_pack_before")
    return ranked.mapInArrow(lambda it: _placed(it, chosen), f"{kinds}, sequence_id long, offset long")
