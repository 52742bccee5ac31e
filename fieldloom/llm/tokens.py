"""Token ids of whole texts by a public tokenizer, with a bounded cache of pieces that words repeat."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from .words import SLICE_BYTES, Words, kept, mix, slices, trim

#: Pieces kept in the cache; beyond, those used once are dropped.
CACHE_PIECES = 300_000
#: Pieces encoded in one call.
JOINED = 256
#: Characters of pieces and ids kept in the cache; beyond, it starts anew.
CACHE_CHARS = CACHE_IDS = 12_000_000
#: A blank or line end between two other characters, where byte-level tokenizers always cut.
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: First byte, second byte, least and most third byte of white space beyond ASCII in UTF-8 (0: no third).
WIDE_SPACE = [(0xC2, 0x85, 0, 0), (0xC2, 0xA0, 0, 0), (0xE1, 0x9A, 0x80, 0x80), (0xE1, 0xA0, 0x8E, 0x8E), (0xE2, 0x80, 0x80, 0x8A), (0xE2, 0x80, 0xA8, 0xA9), (0xE2, 0x80, 0xAF, 0xAF), (0xE2, 0x81, 0x9F, 0x9F), (0xE3, 0x80, 0x80, 0x80)]


#: Which bytes are taken off the end of a word.
MARKS = np.isin(np.arange(256), list(b".,;:!?"))


class _Numbered(dict):
    """Numbers its keys as they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Encoder:
    """A tokenizer file, applied piece by piece; the ids are those of the whole text.

    Both kinds of tokenizer here cut a text into words before they merge anything, so that the pieces between
    blanks and line ends can be encoded once each.  keeps_space: the blank or line end before a word belongs to
    its piece (byte-level vocabularies); otherwise white space only separates words.  The pieces of a
    column are told apart by 64-bit hashes, checked by length and first and last bytes; those kept are
    looked up by their bytes.
    """

    def __init__(self, path: str, pieces: int = CACHE_PIECES):
        self.limit = pieces
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.keeps_space = self.tokenizer.encode(" b", add_special_tokens=False).ids != self.tokenizer.encode("b", add_special_tokens=False).ids
        special = [(i, x.content) for i, x in self.tokenizer.get_added_tokens_decoder().items() if x.special and not (x.lstrip or x.rstrip or x.single_word)]
        self.mark_id, self.mark = special[-1] if special else (None, None)
        self._empty()

    def _empty(self) -> None:
        self.known, self.names = _Numbered(), []
        self.used = self.chars = 0
        self.ids = np.empty(1 << 16, np.uint32)
        self.start, self.size, self.hits = (np.zeros(1 << 16, np.int64) for _ in range(3))

    def _trim(self) -> None:
        """Drop the pieces used once (or all, where those left are still many)."""
        keep = np.flatnonzero(self.hits[: len(self.names)] > 1)
        names = [self.names[i] for i in keep.tolist()]
        starts, sizes = self.start[keep], self.size[keep]
        old = self.ids
        self._empty()
        if len(names) > self.limit // 2 or sizes.sum() > CACHE_IDS // 2:
            return
        self._add(names, old[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))], sizes)
        for x in names:
            self.known[x]

    def _add(self, names: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        n, total = len(self.names), len(ids)
        while len(self.ids) < self.used + total:
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while len(self.start) < n + len(names):
            self.start, self.size, self.hits = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.size, self.hits))
        self.ids[self.used : self.used + total] = ids
        self.size[n : n + len(names)] = sizes
        self.start[n : n + len(names)] = self.used + np.cumsum(sizes) - sizes
        self.names += names
        self.used += total
        self.chars += sum(map(len, names))

    def _spaced(self, w: Words) -> np.ndarray:
        """Which rows have white space other than one blank or line end between two words."""
        data, n = w.data, len(w.data)
        row = w.rows()
        bad = np.zeros(len(w.counts), bool)
        inner = np.ones(len(row), bool)
        inner[w.first[:-1][w.counts > 0]] = False
        gap = w.starts[1:] - w.ends[:-1]
        odd = (gap != 1) | ((data[w.starts[1:] - 1] != 0x20) & (data[w.starts[1:] - 1] != 0x0A))
        bad[row[1:][odd & inner[1:]]] = True
        some = w.counts > 0
        bad[some] |= (w.starts[w.first[:-1][some]] != w.offsets[:-1][some]) | (w.ends[w.first[1:][some] - 1] != w.offsets[1:][some])
        bad |= ~some & (np.diff(w.offsets) > 0)
        at = [np.flatnonzero((data >= 0x1C) & (data <= 0x1F))]
        for a, b, low, high in WIDE_SPACE:
            k = np.flatnonzero(data[: max(0, n - 2 + (low == 0))] == a)
            k = k[data[k + 1] == b]
            at.append(k[(data[k + 2] >= low) & (data[k + 2] <= high)] if low else k)
        at = np.concatenate(at)
        bad[np.searchsorted(w.offsets, at, side="right") - 1] = True
        return bad

    def _places(self, pieces: list[bytes]) -> np.ndarray:
        """Where each piece is in the cache; those not yet in it are encoded."""
        out = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        if len(self.known) > len(self.names):
            fresh = list(islice(self.known, len(self.names), None))
            self._add(fresh, *self._encode([x.decode() for x in fresh]))
        self.hits[: len(self.names)] += np.bincount(out, minlength=len(self.names))
        return out

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces and how many each has.

        Many at a time, with a special token between them, which cuts before anything else does and is cheaper than
        a call for each; one by one where a piece has that token's string in it.
        """
        if self.mark is None or any(self.mark in x for x in pieces):
            encoded = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
            return np.fromiter(chain.from_iterable(encoded), np.uint32, int(counts.sum())), counts
        joined = [self.mark.join([*pieces[i : i + JOINED], ""]) for i in range(0, len(pieces), JOINED)]
        self.tokenizer.encode_special_tokens = False
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        self.tokenizer.encode_special_tokens = True
        marks = ids == self.mark_id
        return ids[~marks], np.diff(np.concatenate(([-1], np.flatnonzero(marks)))) - 1

    def _gather(self, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[piece]
        before = np.cumsum(size) - size
        return self.ids[np.repeat(self.start[piece] - before, size) + np.arange(int(size.sum()))], size

    @staticmethod
    def _marked_off(w: Words, begin: np.ndarray, end: np.ndarray, key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
        """The pieces with a full stop or the like after an ASCII letter as a piece of its own: tokenizers cut there."""
        last, before = w.data[end - 1], w.data[np.maximum(end - 2, 0)] | 0x20
        cut = MARKS[last] & (before >= 0x61) & (before <= 0x7A) & (end - begin > 1)
        at = np.flatnonzero(cut)
        if not len(at):
            return begin, end, key, row
        stem, stem_end = key.copy(), end - cut
        # the hash of a word is a sum over its bytes before it is mixed; a fresh one of the shorter word is as good
        stem[at] = w.hash_of(begin[at], end[at] - 1)
        place = at + 1
        mark = mix(last[at].astype(np.uint64) + np.uint64(0xABCD))
        return tuple(np.insert(x, place, y) for x, y in ((begin, end[at] - 1), (stem_end, end[at]), (stem, mark), (row, row[at])))

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column (null: none), one after the other, and how many each has."""
        if len(self.names) > self.limit or self.used > CACHE_IDS or self.chars > CACHE_CHARS:
            self._trim()
        w = Words(column)
        sizes = np.zeros(len(w.counts), np.int64)
        if not len(w.data):
            return np.zeros(0, np.uint32), sizes
        bad = self._spaced(w) if self.keeps_space else np.zeros(len(w.counts), bool)
        row = w.rows()
        use = np.flatnonzero(~bad[row])
        row = row[use]
        begin, end, key = w.starts[use], w.ends[use], w.hash[use]
        if self.keeps_space:
            lead = (begin != w.offsets[row]).astype(np.int64)
            begin = begin - lead
            key = key ^ (w.data[begin].astype(np.uint64) * lead.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        begin, end, key, row = self._marked_off(w, begin, end, key, row)
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        length = end - begin
        alike = (length == length[first][which]) & (w.data[begin] == w.data[begin[first]][which]) & (w.data[end - 1] == w.data[end[first] - 1][which])
        if not alike.all():  # two words of one hash: each is its own
            odd = np.flatnonzero(~alike)
            first = np.concatenate((first, odd))
            which[odd] = np.arange(len(first) - len(odd), len(first))
        view = memoryview(w.data)
        places = self._places([view[a:b].tobytes() for a, b in zip(begin[first].tolist(), end[first].tolist())])
        ids, size = self._gather(places[which])
        sizes += np.bincount(row, weights=size, minlength=len(sizes)).astype(np.int64)
        if not bad.any():
            return ids, sizes
        parts, cuts = [], np.concatenate(([0], np.cumsum(sizes)))
        for i in range(len(sizes)):
            if bad[i]:
                pieces = CUT.split(view[w.offsets[i] : w.offsets[i + 1]].tobytes().decode())
                found, _ = self._gather(self._places([x.encode() for x in pieces if x]))
                sizes[i] = len(found)
                parts.append(found)
            else:
                parts.append(ids[cuts[i] : cuts[i + 1]])
        return np.concatenate(parts), sizes


def encoder(path: str, pieces: int = CACHE_PIECES) -> Encoder:
    """This worker's encoder of a tokenizer file."""
    return kept(("encoder", path, pieces), lambda: Encoder(path, pieces))


def encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None, pieces: int = CACHE_PIECES, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches with the ids of their texts (null: none), each followed by end_id, and the counts."""
    trim()
    for batch in batches:
        for part in slices(batch, limit=limit):
            ids, sizes = encoder(path, pieces).encode_column(part.column("text"))
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                sizes = sizes + 1
            yield part, ids, sizes
