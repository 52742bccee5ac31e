"""Words of Arrow text columns as NumPy arrays: positions and 64-bit hashes, computed a slice at a time.

A word is a run of bytes other than 0x20 and 0x09-0x0D.  Those separators are ASCII, so that UTF-8 text
can be cut at byte level.
"""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer row is a slice of its own.
SLICE_BYTES = 4 << 20
#: Bytes hashed at once, so that the temporary arrays stay in the processor's cache.
SEGMENT_BYTES = 1 << 17
BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, for tables that are costly to build."""
    return sys.modules.setdefault("_fieldloom_worker", types.ModuleType("_fieldloom_worker")).__dict__


def kept(key: object, make):
    """What make() gives, kept in the worker until another such thing is wanted: one at a time, since they are large."""
    cache = worker_cache()
    if cache.get("kept", (None,))[0] != key:
        release()
        cache["kept"] = (key, make())
    return cache["kept"][1]


def release() -> None:
    """Let go of what kept() holds, before an operator that needs the room, and give free memory back."""
    worker_cache().pop("kept", None)
    trim()


def trim() -> None:
    """Give free memory back, and keep what kept() holds."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i below n at least."""
    cache = worker_cache()
    if len(cache.get("powers", ((),))[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        pair = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.ones(size, np.uint64)
            done = 1
            while done < size:
                p[done : 2 * done] = p[:done] * np.uint64(pow(base, done, 1 << 64))
                done *= 2
            pair.append(p)
        cache["powers"] = tuple(pair)
    return cache["powers"]


def byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes separate words, and a random number for each byte, as it is and with A-Z lower-cased."""
    cache = worker_cache()
    if "bytes" not in cache:
        separates = np.zeros(256, bool)
        separates[[0x20, *range(0x09, 0x0E)]] = True
        plain = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        lower = plain.copy()
        lower[65:91] = plain[97:123]
        cache["bytes"] = separates, plain, lower
    return cache["bytes"]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about so many bytes of text each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(a, b - a)


class Words:
    """The words of a text column: start and end bytes, hash, and the index of the first word of each row."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.offsets = raw(column)
        n = len(self.data)
        separates, plain, lowered = byte_tables()
        inside = ~separates[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:n]
        ends[:-1] &= ~inside[1:] | edge[1:n]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.hash = self._hash(lowered if lower else plain)

    def _hash(self, table: np.ndarray) -> np.ndarray:
        self._table = table
        return self.hash_of(self.starts, self.ends)

    def hash_of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of stretches of bytes, in order of where they start and none within another."""
        out, i = np.empty(len(starts), np.uint64), 0
        while i < len(out):
            a = starts[i]
            j = max(i + 1, int(np.searchsorted(starts, a + SEGMENT_BYTES)))
            b = ends[j - 1]
            up, down = powers(int(b - a) + 1)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(self._table[self.data[a:b]] * up[: b - a], out=sums[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
            i = j
        return mix(out)

    def rows(self) -> np.ndarray:
        """For each word, the index of its row."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


class RunHash:
    """Hashes of runs of consecutive items, from prefix sums."""

    def __init__(self, items: np.ndarray):
        up, self.down = powers(len(items) + 1)
        self.sums = np.zeros(len(items) + 1, np.uint64)
        np.cumsum(items * up[: len(items)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def heads(x: np.ndarray) -> np.ndarray:
    """Where a value begins that the item before doesn't have."""
    head = np.ones(len(x), bool)
    head[1:] = x[1:] != x[:-1]
    return head


def grouped_order(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The order by group (sorted already) and value (64 bits): as one number, as far as its bits go, and by all where they don't tell."""
    if not len(group):
        return np.zeros(0, np.int64)
    bits = int(group[-1]).bit_length()
    key = (group.astype(np.uint64) << np.uint64(64 - bits)) | (value >> np.uint64(bits)) if bits else value
    order = np.argsort(key)
    key, value = key[order], value[order]
    if bits and bool(((key[1:] == key[:-1]) & (value[1:] != value[:-1])).any()):
        order = order[np.lexsort((value, group[order]))]
    return order


def number_batch(schema: str, *columns) -> pa.RecordBatch:
    """Columns of numbers (or Arrow arrays) as a batch of this schema of ints and longs."""
    kinds = {"int": pa.int32(), "long": pa.int64()}
    fields = [x.split() for x in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(signed(c) if c.dtype == np.uint64 else c, kinds[k]) for c, (_, k) in zip(columns, fields)]
    return pa.record_batch(arrays, names=[n for n, _ in fields])


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed number, which is what Spark's long holds."""
    return x.view(np.int64)
