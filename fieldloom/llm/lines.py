"""Line dedup: an exact set-similarity join of lines by prefix, positional and length filters."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import alike, removed, written
from .words import Words, grouped_order, heads, mix, number_batch, raw, release, signed, slices

#: Buckets of token counts (one byte each on every executor), in parts of 2**PART_BITS; what is rare is known by bucket.
BUCKET_BITS, PART_BITS = 22, 14
#: Sizes of one band span this factor, and a band has so many composite tokens for each that may differ.
SPAN, SPARE = 3, Fraction(3, 2)
#: Sets of a key whose pairs are all made at once; beyond, each is compared with so many of the first.
GROUP = 64
#: Sets of a key up to which each is compared with all others by its parities where it is; those with so many pairs that they'd add up go on as rows.
CROWD, CLOSE = 1 << 14, 8
#: Parities that are compared at once.
BLOCK = 1 << 20
#: Candidates a set gets from those first ones.
NEAREST = 2
#: Words of 64 parity bits that candidates are compared by before their tokens are.
WIDE = 4
#: Pairs up to which the ids of their lines are broadcast.
FEW = 200_000
#: Set ids a task remembers, so that a line that it met before emits its keys once.
SEEN = 1 << 20


def _buckets(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


class LineSets:
    """The lines of a text column as sets of tokens (words, A-Z in lower case): one group for each line that has any.

    row and line of each group, its number of different tokens, and the tokens' hashes, group by group.
    """

    def __init__(self, column: pa.Array):
        w = Words(column, lower=True)
        ends = np.flatnonzero(w.data == 10)
        row = w.rows()
        at = np.repeat(np.arange(len(ends) + 1), np.diff(np.searchsorted(w.starts, ends), prepend=0, append=len(w.starts)))
        at = at - np.searchsorted(ends, w.offsets[:-1])[row]
        new = heads(row) | heads(at)
        group = np.cumsum(new) - 1
        self.row, self.line = row[new], at[new]
        order = grouped_order(group, w.hash)
        token, group = w.hash[order], group[order]
        once = heads(token) | heads(group)
        self.token, self.group = token[once], group[once]
        self.size = np.bincount(self.group, minlength=len(self.row))
        self.begin = np.cumsum(self.size) - self.size

    def _sum(self, items: np.ndarray) -> np.ndarray:
        return np.add.reduceat(items, self.begin) if len(self.size) else np.zeros(0, np.uint64)

    def parities(self) -> np.ndarray:
        """64 bits, each flipped by every token that falls to it: two sets differ in at least as many tokens as bits."""
        if not len(self.size):
            return np.zeros(0, np.uint64)
        return np.bitwise_xor.reduceat(np.uint64(1) << (mix(self.token) & np.uint64(63)), self.begin)

    def wide_parities(self) -> list[np.ndarray]:
        """The same with WIDE times as many bits, which leaves few tokens to cancel out."""
        if not len(self.size):
            return [np.zeros(0, np.uint64)] * WIDE
        spot = mix(self.token + np.uint64(7))
        bit, word = np.uint64(1) << (spot & np.uint64(63)), (spot >> np.uint64(6)) % np.uint64(WIDE)
        return [np.bitwise_xor.reduceat(np.where(word == i, bit, np.uint64(0)), self.begin) for i in range(WIDE)]

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each set, whatever the order of its tokens."""
        return tuple(mix(self._sum(mix(self.token + np.uint64(salt))) + self.size.astype(np.uint64)) for salt in (1, 1 << 40))


class Rule:
    """What a similarity (p / q) asks of two sets, by their sizes.

    Sets are dealt to bands by size; of two that match, the smaller one's band is the pair's.  In a band the tokens
    of all documents are dealt, by hash, to a fixed number of places; what a set has at a place is one composite
    token.  Two sets that differ in d tokens differ in d composites at most, so they share one among the first
    d + 1 of each in any order: the rarest are taken, which are rarer by far than single tokens.
    """

    def __init__(self, rate: Fraction):
        self.p, self.q = rate.as_integer_ratio()
        self.least = -(-self.p // (self.q - self.p))  # smaller sets match equal ones only
        edges = [self.least]
        while edges[-1] < 1 << 40:
            edges.append(edges[-1] * SPAN)
        self.edges = np.array(edges)
        most = self.edges[1:] - 1
        self.places = [int(-(-(int(self.room(a + b)) + 1) * SPARE.numerator // SPARE.denominator)) for a, b in zip(most, most * self.q // self.p)]

    def room(self, total):
        """Tokens in which two sets of so many together may differ."""
        return (self.q - self.p) * total // (self.q + self.p)

    def keys(self, s: LineSets, live: np.ndarray, order: np.ndarray, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Sets, keys and ranks: the rarest composites of each live set in its own band, and in the one below where a partner may be in it.

        order: the code of each bucket (see _codes); shift: the code of a token that every line has.
        """
        band = np.searchsorted(self.edges, s.size, side="right") - 1
        below = self.edges[np.maximum(band, 0)] - 1
        yield from self._of(s, live & (band >= 0), band, self.room(s.size + s.size * self.q // self.p), order, shift)
        yield from self._of(s, live & (band >= 1) & (self.q * below >= self.p * s.size), band - 1, self.room(s.size + below), order, shift)

    def _of(self, s: LineSets, which: np.ndarray, band: np.ndarray, room: np.ndarray, order: np.ndarray, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        sets = np.flatnonzero(which)
        if not len(sets):
            return
        many = np.array(self.places[: int(band[sets].max()) + 1], np.int64)[band[sets]]
        ends = np.cumsum(many)
        local = np.full(len(which), -1)
        local[sets] = np.arange(len(sets))
        mine = local[s.group]
        use = mine >= 0
        mine, token = mine[use], mix(s.token[use])
        at = (ends - many)[mine] + (mix(token + band[sets][mine].astype(np.uint64)) % many[mine].astype(np.uint64)).astype(np.int64)
        code = order[_buckets(s.token[use])].astype(np.int64)
        held = np.bincount(at, minlength=int(ends[-1]))
        place = np.flatnonzero(held)
        total = np.zeros(len(held), np.uint64)
        np.add.at(total, at, token)
        rarity = np.bincount(at, weights=code, minlength=len(held))[place] - (held[place] - 1) * shift
        alone = np.bincount(at, weights=code == 1, minlength=len(held))[place] > 0  # with a token that occurs once in all documents
        rank_by = np.where(alone, 0, np.clip(rarity + (1 << 15), 1, (1 << 16) - 1)).astype(np.uint64)
        owner = np.repeat(np.arange(len(sets)), many)[place]
        key = mix(total[place] + mix((place - (ends - many)[owner]).astype(np.uint64) * np.uint64(64) + band[sets][owner].astype(np.uint64)))
        sort = grouped_order(owner, (rank_by << np.uint64(48)) | (key >> np.uint64(16)))
        owner, key, alone = owner[sort], key[sort], alone[sort]
        count = np.bincount(owner, minlength=len(sets))
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        keep = (rank <= room[sets][owner]) & ~alone
        yield sets[owner[keep]], key[keep], rank[keep]


def _places(part: pa.RecordBatch, row: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """doc_id of each line, and its place: the text's tag above, the line's number below."""
    doc = part.column("doc_id").to_numpy(zero_copy_only=False)[row]
    tag = part.column("tag").to_numpy(zero_copy_only=False).astype(np.int64)[row]
    return doc, (tag << 32) | line


COUNTS = "part int, bucket binary, n binary"


def _by_part(counts: np.ndarray, sets: int) -> pa.RecordBatch:
    """For each part of the buckets, those that have any token and their counts; last, how many sets there are."""
    found = np.flatnonzero(counts)
    cuts = np.searchsorted(found, np.arange(0, len(counts) + 1, 1 << PART_BITS))
    rows = [(i, (found[a:b] & ((1 << PART_BITS) - 1)).astype("<u2").tobytes(), counts[found[a:b]].astype("<i8").tobytes()) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
    rows.append((-1, np.zeros(1, "<u2").tobytes(), np.array([sets], "<i8").tobytes()))
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["part", "bucket", "n"])


def _counts(batches: Iterator[pa.RecordBatch], tokens) -> Iterator[pa.RecordBatch]:
    """How many tokens the task's texts have in each bucket (see _by_part).

    tokens: of a text column the tokens of all its sets, and how many sets there are at most.
    """
    release()
    counts, sets = np.zeros(1 << BUCKET_BITS, np.int64), 0
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            found, many = tokens(part.column("text"))
            np.add.at(counts, _buckets(found), 1)
            sets += many
    yield _by_part(counts, sets)


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From counts sorted by part, one row a part: a byte a bucket, 0 for no token, 1 for one, more by the logarithm of how many."""
    now, sums = None, None

    def coded() -> pa.RecordBatch:
        codes = np.where(sums < 2, sums, np.minimum(255, 2 + np.floor(8 * np.log2(np.maximum(sums, 1)))))
        return pa.record_batch([pa.array([now], pa.int32()), pa.array([codes.astype(np.uint8).tobytes()], pa.binary())], names=["part", "codes"])

    for batch in batches:
        for part, bucket, n in zip(batch.column("part").to_pylist(), batch.column("bucket"), batch.column("n")):
            if part != now:
                if now is not None:
                    yield coded()
                now, sums = part, np.zeros(1 << PART_BITS if part >= 0 else 1, np.int64)
            sums[np.frombuffer(bucket.as_buffer(), "<u2")] += np.frombuffer(n.as_buffer(), "<i8")
    if now is not None:
        yield coded()


def rarity(docs: DataFrame, tokens) -> tuple[np.ndarray, int]:
    """The code of each bucket of tokens (see _codes), and that of a token that every set has."""
    return _summed(docs.select("text").mapInArrow(lambda it: _counts(it, tokens), COUNTS))


def _summed(counts: DataFrame) -> tuple[np.ndarray, int]:
    """rarity() of the counts of all tasks."""
    coded, path = written(counts.repartition("part").sortWithinPartitions("part").mapInArrow(_codes, "part int, codes binary"), "codes")
    order, shift = np.zeros(1 << BUCKET_BITS, np.uint8), 0
    for row in coded.collect():  # 2**(BUCKET_BITS - PART_BITS) rows of 2**PART_BITS bytes
        if row["part"] < 0:
            shift = row["codes"][0]
        else:
            order[row["part"] << PART_BITS : (row["part"] + 1) << PART_BITS] = np.frombuffer(row["codes"], np.uint8)
    removed(counts.sparkSession, path)
    return order, shift


#: Of a key's set: key, x (its id), y (parities), place (size, and rank of the key).
#: kind 1: a pair of ids (x, y).  kind 2: a row of a key that more than GROUP sets have.
KEYS = "key long, x long, y long, place long"
FOUND = "kind int, key long, x long, y long, place long"


LINES = "x long, y long, doc_id long, place long"
#: Bytes of text whose lines are made at once.
SLICE = 1 << 20


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's lines: the ids of their sets, doc_id and place; last, the counts of their tokens (see _by_part)."""
    release()
    names = [x.split()[0] for x in f"{LINES}, {COUNTS}".split(", ")]
    counts, sets = np.zeros(1 << BUCKET_BITS, np.int64), 0
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            s = LineSets(part.column("text"))
            np.add.at(counts, _buckets(s.token), 1)
            sets += len(s.row)
            found = number_batch(LINES, *s.ids(), *_places(part, s.row, s.line))
            yield pa.RecordBatch.from_arrays([*found.columns, *(pa.nulls(len(s.row), k) for k in (pa.int32(), pa.binary(), pa.binary()))], names=names)
    found = _by_part(counts, sets)
    yield pa.RecordBatch.from_arrays([*[pa.nulls(found.num_rows, pa.int64())] * 4, *found.columns], names=names)


#: Rows of keys that a task holds before it sends them; parts a shuffle partition has; bytes of each number of a row.
HOLD, PARTS, PACKED = 1 << 18, 4, (6, 8, 8, 6)
SENT = "spot long, part int, rows binary"


def _packed(rows: np.ndarray, spots: np.ndarray) -> pa.RecordBatch:
    """Rows (KEYS) by part of the keys' range: spot (which deals it), part, and the rows' bytes, the first of all rows first (so that zeros go together)."""
    part = ((rows[0].view(np.uint64) >> np.uint64(32)) * np.uint64(len(spots) * PARTS)) >> np.uint64(32)
    order = np.argsort(part.astype(np.uint16) if len(spots) * PARTS <= 1 << 16 else part, kind="stable")  # numbers of 16 bits are sorted by radix
    part = part[order].astype(np.int64)
    begins = np.flatnonzero(heads(part))
    planes = np.concatenate([np.ascontiguousarray(x[order]).view(np.uint8).reshape(-1, 8)[:, :n].T for x, n in zip(rows, PACKED)])
    found = [planes[:, a:b].tobytes() for a, b in zip(begins, np.append(begins[1:], len(part)))]
    return pa.record_batch([pa.array(spots[part[begins] // PARTS]), pa.array(part[begins].astype(np.int32)), pa.array(found, pa.binary())], names=["spot", "part", "rows"])


def _unpacked(data: bytes) -> np.ndarray:
    """The rows of a part; of a key only the low bytes, by which those of a part are told apart."""
    planes = np.frombuffer(data, np.uint8).reshape(sum(PACKED), -1)
    rows, at = np.zeros((len(PACKED), planes.shape[1], 8), np.uint8), 0
    for i, n in enumerate(PACKED):
        rows[i, :, :n] = planes[at : at + n].T
        at += n
    return rows.reshape(len(PACKED), -1).view(np.int64)


def _keys(batches: Iterator[pa.RecordBatch], shared, rate: Fraction) -> Iterator[pa.RecordBatch]:
    """The keys of the sets of the task's lines, packed by part."""
    release()
    (order, shift, spots), rule = shared.value, Rule(rate)
    seen, held, many = np.zeros(0, np.uint64), [], 0
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            s = LineSets(part.column("text"))
            first, _ = s.ids()
            new, at = np.unique(first, return_index=True)
            fresh = np.searchsorted(seen, new) == np.searchsorted(seen, new, side="right")  # seen is sorted
            live = np.zeros(len(first), bool)
            live[at[fresh]] = True
            seen = np.sort(np.concatenate((seen, new[fresh])), kind="stable") if len(seen) < SEEN else new
            bits = s.parities()
            for sets, key, rank in rule.keys(s, live, order, shift):
                held.append(np.stack((signed(key), signed(first[sets]), signed(bits[sets]), (s.size[sets] << 16) | np.minimum(rank, 0xFFFF))))
                many += len(key)
            if many >= HOLD:
                yield _packed(np.concatenate(held, axis=1), spots)
                held, many = [], 0
    if many:
        yield _packed(np.concatenate(held, axis=1), spots)


def _sorted(batches: Iterator[pa.RecordBatch], group: int, most: int) -> Iterator[pa.RecordBatch]:
    """From packed rows sorted by part: the rows (KEYS) of each part, sorted by key.

    Where a part has more than `most` rows, those of keys that more than `group` sets have go on at once, as FOUND, so that they aren't held.
    """
    now, held, many, hot, limit = None, [], 0, np.zeros(0, np.int64), most

    def taken() -> pa.RecordBatch:
        rows = np.concatenate(held, axis=1)
        return number_batch(KEYS, *rows[:, np.argsort(rows[0])])

    for batch in batches:
        for part, data in zip(batch.column("part").to_pylist(), batch.column("rows")):
            if part != now:
                if many:
                    yield taken()
                now, held, many, hot, limit = part, [], 0, hot[:0], most
            rows = _unpacked(data.as_buffer())
            if len(hot):
                large = np.isin(rows[0], hot)
                if large.any():
                    yield _large(rows[:, large])
                rows = rows[:, ~large]
            held.append(rows)
            many += rows.shape[1]
            if many > limit:
                rows = _once(np.concatenate(held, axis=1))
                begins = np.flatnonzero(heads(rows[0]))
                count = np.diff(np.append(begins, rows.shape[1]))
                large = np.repeat(count > group, count)
                if large.any():
                    hot = np.concatenate((hot, rows[0, begins[count > group]]))
                    yield _large(rows[:, large])
                held = [rows[:, ~large]]
                many = held[0].shape[1]
                limit = max(most, 2 * many)
    if many:
        yield taken()


def _once(rows: np.ndarray) -> np.ndarray:
    """The rows sorted by key and set, each set once."""
    rows = rows[:, np.lexsort((rows[1], rows[0]))]
    return rows[:, heads(rows[0]) | heads(rows[1])]


def _large(rows: np.ndarray) -> pa.RecordBatch:
    key, x, bits, info = rows
    return number_batch(FOUND, np.full(len(key), 2, np.int32), key, x, bits, info)


#: Rows of a part from which those of large keys are no longer held.
MOST = 1 << 20


def _spots(spark: SparkSession) -> np.ndarray:
    """A number for each shuffle partition that Spark's hash deals there, so that each gets as many parts."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = spark.range(n * 30 + 100).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("to")).groupBy("to").agg(F.min("id").alias("id")).collect()
    spots = np.arange(n, dtype=np.int64)  # where none is found, any will do
    for row in found:
        spots[row["to"]] = row["id"]
    return spots


def _may_match(a: tuple, b: tuple, rule: Rule) -> np.ndarray:
    """The filters on rows of a key (parities; size and rank): by length; by rank (of two sets whose first common key this is, all before differ); by parities."""
    (a_bits, a_info), (b_bits, b_info) = a, b
    a_size, b_size = a_info >> 16, b_info >> 16
    room = rule.room(a_size + b_size)
    fits = rule.q * np.minimum(a_size, b_size) >= rule.p * np.maximum(a_size, b_size)
    return fits & (np.maximum(a_info & 0xFFFF, b_info & 0xFFFF) <= room) & (np.bitwise_count((a_bits ^ b_bits).view(np.uint64)) <= room)


def _crowd(rows: np.ndarray, rule: Rule, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a key's sets: the pairs that may match of each set with `most` of them at most, and the rows of the other sets, which may also match each other."""
    rows = rows[:, np.argsort(rows[3] >> 16, kind="stable")]
    _, x, bits, info = rows
    size = info >> 16
    room = rule.room(size + size * rule.q // rule.p).astype(np.uint8 if size[-1] < 500 else np.int64)  # with the largest partner
    since, until = np.searchsorted(size, -(-rule.p * size // rule.q)), np.searchsorted(size, size * rule.q // rule.p, side="right")
    pairs, many, step = [np.zeros((2, 0), np.int64)], np.zeros(len(x), bool), max(1, BLOCK // len(x))
    for i in range(0, len(x), step):
        j = min(i + step, len(x))
        first, last = int(since[i]), int(until[j - 1])
        a, b = np.nonzero(np.bitwise_count((bits[i:j, None] ^ bits[None, first:last]).view(np.uint64)) <= room[i:j, None])
        a, b = a + i, b + first
        fits = (a != b) & _may_match((bits[a], info[a]), (bits[b], info[b]), rule)
        a, b = a[fits], b[fits]
        many[i:j] = np.bincount(a - i, minlength=j - i) > most
        a, b = a[~many[a]], b[~many[a]]
        pairs.append(np.stack((np.minimum(x[a], x[b]), np.maximum(x[a], x[b]))))
    return np.concatenate(pairs, axis=1), rows[:, many]


def _candidates(batches: Iterator[pa.RecordBatch], rate: Fraction, group: int, crowd: int = 0) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: pairs of sets that may match, and the rows of keys that more than `group` sets have.

    Of keys that no more than `crowd` sets have, only the rows of sets with many pairs (see _crowd).  Memory holds one
    batch and at most so many sets of the key that goes on in the next one.  Batches of FOUND go through.
    """
    release()
    rule, most = Rule(rate), max(group, crowd)
    carry, hot = np.zeros((4, 0), np.int64), None

    def kinds(kind: int, n: int) -> np.ndarray:
        return np.full(n, kind, np.int32)

    def done(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All whole runs of these rows (sorted by key and set, each once)."""
        key, x, bits, info = rows
        begins = np.flatnonzero(heads(key))
        count = np.diff(np.append(begins, len(key)))
        run = np.repeat(count, count)
        if (run > most).any():
            yield _large(rows[:, run > most])
        pairs = []
        for k in np.flatnonzero((count > group) & (count <= most)):
            found, many = _crowd(rows[:, begins[k] : begins[k] + count[k]], rule, CLOSE)
            pairs.append(found)
            if many.shape[1]:
                yield _large(many)
        left = np.repeat(begins + count, count) - np.arange(len(key))  # rows of the key from here on
        i, step = np.flatnonzero((run <= group) & (left > 1)), 1
        size = info >> 16
        room = rule.room(size + size * rule.q // rule.p)  # with the largest partner
        while len(i):
            k = i[np.bitwise_count((bits[i] ^ bits[i + step]).view(np.uint64)) <= room[i]]
            k = k[_may_match((bits[k], info[k]), (bits[k + step], info[k + step]), rule)]
            pairs.append(np.stack((x[k], x[k + step])))
            step += 1
            i = i[left[i] > step]
        if pairs and sum(p.shape[1] for p in pairs):
            a, b = np.concatenate(pairs, axis=1)  # sets are in order within a key
            order = np.lexsort((b, a))
            order = order[heads(a[order]) | heads(b[order])]
            none = pa.nulls(len(order), pa.int64())
            yield number_batch(FOUND, kinds(1, len(order)), none, a[order], b[order], none)

    def shared_runs(rows: np.ndarray) -> np.ndarray:
        """The rows of keys that several have, sorted by key and set, each set once."""
        head = heads(rows[0])
        rows = rows[:, ~(head & np.append(head[1:], True))]
        return _once(rows)

    for batch in batches:
        if batch.num_columns > 4:
            yield batch
            continue
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(i).to_numpy() for i in range(4)])
        if hot is not None:
            n = int(np.searchsorted(rows[0], hot, side="right"))
            yield _large(rows[:, :n])
            rows = rows[:, n:]
            if not rows.shape[1]:
                continue
            hot = None
        rows = np.concatenate((carry, rows), axis=1)
        last = int(np.searchsorted(rows[0], rows[0, -1]))
        yield from done(shared_runs(rows[:, :last]))
        carry = rows[:, last:]
        if carry.shape[1] > most:
            carry = shared_runs(carry)
            if carry.shape[1] > most:
                yield _large(carry)
                carry, hot = carry[:, :0], rows[0, -1]
    yield from done(shared_runs(carry))


PAIRS = "a_doc long, a_place long, b_doc long, b_place long"


def _stars(batches: Iterator[pa.RecordBatch], rate: Fraction, group: int, nearest: int) -> Iterator[pa.RecordBatch]:
    """From rows (key, y, info, doc_id, place) sorted by key, document and place: the nearest earlier ones among the first `group` of the key.

    Pairs; and, with a_doc null, the lines that may match others too.
    """
    rule, now, first, at = Rule(rate), None, None, 0
    for batch in batches:
        key, bits, info, doc, place = (c.to_numpy() for c in batch.columns)
        cuts = [*np.flatnonzero(heads(key)).tolist(), len(key)]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if key[i] != now:
                now, first, at = key[i], np.zeros((4, 0), np.int64), 0
            run = np.stack((bits[i:j], info[i:j], doc[i:j], place[i:j]))
            first = np.concatenate((first, run[:, : max(0, group - first.shape[1])]), axis=1)
            number = at + np.arange(j - i)
            at += j - i
            for k in range(0, j - i, 1 << 12):
                part, n = run[:, k : k + (1 << 12)], number[k : k + (1 << 12)]
                ok = _may_match((part[0][:, None], part[1][:, None]), (first[0][None], first[1][None]), rule)
                ok &= np.arange(first.shape[1])[None] < n[:, None]
                far = np.where(ok, np.bitwise_count((part[0][:, None] ^ first[0][None]).view(np.uint64)).astype(np.int64), 1 << 10)
                near = np.argsort(far, axis=1, kind="stable")[:, :nearest]
                b, c = np.nonzero(np.take_along_axis(ok, near, 1))
                a = near[b, c]
                yield number_batch(PAIRS, first[2][a], first[3][a], part[2][b], part[3][b])
                more = np.flatnonzero((ok.sum(axis=1) > nearest) | (n > group))
                none = pa.nulls(len(more), pa.int64())
                yield number_batch(PAIRS, none, none, part[2][more], part[3][more])


def _cut(part: pa.RecordBatch, column: str) -> tuple[np.ndarray, ...]:
    """The bytes of the texts, where each line starts and ends, its row and number, and whether its place is in this list of its row."""
    data, offsets = raw(part.column("text"))
    ends = np.flatnonzero(data == 10)
    row_ends = offsets[1:]
    row = np.searchsorted(row_ends, ends, side="right")  # of the line that each line end ends
    stop = np.concatenate((ends, row_ends))
    row = np.concatenate((row, np.arange(len(row_ends))))
    order = np.lexsort((stop, row))
    stop, row = stop[order], row[order]
    head = heads(row)
    start = offsets[row]
    start[~head] = stop[:-1][~head[1:]] + 1
    begins = np.flatnonzero(head)
    number = np.arange(len(row)) - begins[row]
    lists = part.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(part.num_rows), pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    mine = (flat >> 32) == part.column("tag").to_numpy(zero_copy_only=False)[owner]
    listed = np.zeros(len(row), bool)
    listed[begins[owner[mine]] + (flat[mine] & 0xFFFFFFFF)] = True
    return data, start, stop, row, number, listed


PARITIES = [f"w{i}" for i in range(WIDE)]


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens and wide parities of the lines that are listed; of rows that repeat an id and a text, the task's first alone."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            names = list(zip(*(part.column(c).to_pylist() for c in ("doc_id", "tag"))))
            first = [not (x in seen or seen.add(x)) for x in names]
            if len(seen) > SEEN:  # what comes again later is only a repeated row
                seen.clear()
            part = part.filter(pa.array(first, pa.bool_()))
            data, start, stop, row, number, listed = _cut(part, "places")
            k = np.flatnonzero(listed)
            size = stop[k] - start[k]
            cuts = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
            chosen = data[np.repeat(start[k] - cuts[:-1], size) + np.arange(int(cuts[-1]))]
            s = LineSets(pa.LargeStringArray.from_buffers(len(k), pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(chosen))))
            doc, place = _places(part, row[k[s.row]], number[k[s.row]])
            at = np.concatenate(([0], np.cumsum(s.size))).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(at), pa.array(signed(s.token)))
            yield pa.record_batch([pa.array(doc), pa.array(place), tokens, *(pa.array(signed(x)) for x in s.wide_parities())], names=["doc_id", "place", "tokens", *PARITIES])


LINE = ["doc_id", "place"]


def _tokens(named: DataFrame, lines: DataFrame) -> tuple[DataFrame, str]:
    """doc_id, place, tokens and wide parities of these lines, in a table of its own, and its path.

    Rows of one doc_id meet in one task but where a join is split or broadcast; repeats that this leaves do no harm.
    """
    lists = lines.groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    return written(named.join(lists, "doc_id").mapInArrow(_needed, "doc_id long, place long, tokens array<long>, " + ", ".join(f"{w} long" for w in PARITIES)), "sets")


def _close(pairs: DataFrame, sets: DataFrame, rate: Fraction) -> DataFrame:
    """The pairs that may match by their sizes and wide parities, and (far) in how many bits they differ; no tokens are moved."""
    p, q = rate.as_integer_ratio()
    for t in "ab":
        side = sets.select(F.col("doc_id").alias(f"{t}_doc"), F.col("place").alias(f"{t}_place"), F.size("tokens").alias(f"{t}_size"), *(F.col(w).alias(f"{t}_{w}") for w in PARITIES))
        pairs = pairs.join(side, [f"{t}_doc", f"{t}_place"])
    far = sum((F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in PARITIES), F.lit(0))
    total = F.col("a_size") + F.col("b_size")
    fits = (q * F.least("a_size", "b_size") >= p * F.greatest("a_size", "b_size")) & ((q + p) * far <= (q - p) * total)
    return pairs.filter(fits).select("a_doc", "a_place", "b_doc", "b_place", far.alias("far")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, rate: Fraction) -> DataFrame:
    """doc_id and place of each later line of the pairs whose similarity is high enough."""
    sides = (sets.select(F.col("doc_id").alias(f"{t}_doc"), F.col("place").alias(f"{t}_place"), F.col("tokens").alias(t)) for t in "ab")
    for t, side in zip("ab", sides):
        pairs = pairs.join(side, [f"{t}_doc", f"{t}_place"])
    return pairs.filter(alike("a", "b", rate)).select(F.col("b_doc").alias("doc_id"), F.col("b_place").alias("place")).distinct()


def _match_earlier(waiting: DataFrame, rows: DataFrame, sets: DataFrame, rate: Fraction) -> DataFrame:
    """Which of the lines that wait match an earlier one of a key they are in, of all that its rows have.

    A semi-join by key and by sizes that a match can have, so that no pairs are made; the filters come before the tokens.
    Only rows of keys in which a line waits are given their tokens.
    """
    p, q = rate.as_integer_ratio()
    size, rank = (lambda t: F.shiftright(f"{t}.info", 16)), (lambda t: F.col(f"{t}.info").bitwiseAND(0xFFFF))
    step = F.floor(F.log(F.shiftright("info", 16).cast("double")) / F.log(F.lit(q / p)))
    rows = rows.join(rows.join(waiting, LINE, "left_semi").select("key").distinct(), "key", "left_semi").withColumn("step", step).join(sets, LINE)
    a, b = rows.alias("a"), rows.join(waiting, LINE, "left_semi").withColumn("step", F.explode(F.array(F.col("step") - 1, "step", F.col("step") + 1))).alias("b")
    room = F.floor((q - p) * (size("a") + size("b")) / F.lit(q + p))
    fits = (q * F.least(size("a"), size("b")) >= p * F.greatest(size("a"), size("b"))) & (F.greatest(rank("a"), rank("b")) <= room)
    fits = fits & (F.bit_count(F.col("a.y").bitwiseXOR(F.col("b.y"))) <= room)
    earlier = F.struct("a.doc_id", "a.place") < F.struct("b.doc_id", "b.place")
    met = (F.col("a.key") == F.col("b.key")) & (F.col("a.step") == F.col("b.step"))
    return b.join(a, met & earlier & fits & alike("a.tokens", "b.tokens", rate), "left_semi").select(*LINE).distinct()


def _gone(named: DataFrame, rate: Fraction) -> DataFrame:
    """doc_id and the places of its lines that go, in a table of its own."""
    spark, paths = named.sparkSession, []
    lines, lines_path = written(named.mapInArrow(_lines, f"{LINES}, {COUNTS}"), "lines")
    shared = spark.sparkContext.broadcast((*_summed(lines.filter("part is not null").select("part", "bucket", "n")), _spots(spark)))
    lines = lines.filter("part is null").select("x", "y", *LINE)
    keys = named.mapInArrow(lambda it: _keys(it, shared, rate), SENT).repartition(len(shared.value[2]), "spot").sortWithinPartitions("part").select("part", "rows")
    found, path = written(keys.mapInArrow(lambda it, group=GROUP, crowd=max(GROUP, CROWD), most=MOST: _candidates(_sorted(it, crowd, most), rate, group, crowd), FOUND), "candidates")
    candidates = path
    firsts, path = written(lines.groupBy("x", "y").agg(F.min(F.struct("doc_id", "place")).alias("f")).select("x", "y", F.col("f.doc_id").alias("doc_id"), F.col("f.place").alias("place")), "firsts")
    paths.append(path)
    same = lines.join(firsts.select("x", "y", F.struct("doc_id", "place").alias("f")), ["x", "y"]).filter(F.struct("doc_id", "place") > F.col("f")).select("doc_id", "place")
    same, path = written(same, "same")
    paths.append(path)
    removed(spark, lines_path)
    one = lambda t, c: firsts.select(F.col("x").alias(c), F.struct(*LINE).alias(t))
    pairs = found.filter("kind = 1").select("x", "y").distinct().join(one("f", "x"), "x").join(one("g", "y"), "y")
    pairs = pairs.select(F.least("f", "g").alias("a"), F.greatest("f", "g").alias("b")).filter("a < b")
    pairs = pairs.select(F.col("a.doc_id").alias("a_doc"), F.col("a.place").alias("a_place"), F.col("b.doc_id").alias("b_doc"), F.col("b.place").alias("b_place"))
    large = found.filter("kind = 2").select("key", "x", "y", F.col("place").alias("info"))
    large, path = written(large.distinct().join(firsts.select("x", *LINE), "x").select("key", "y", "info", *LINE), "large")
    paths.append(path)
    stars, path = written(large.repartition("key").sortWithinPartitions("key", *LINE).mapInArrow(lambda it, group=GROUP, nearest=NEAREST: _stars(it, rate, group, nearest), PAIRS), "stars")
    paths.append(path)
    pairs, pairs_path = written(pairs.union(stars.filter("a_doc is not null")).distinct(), "pairs")
    removed(spark, candidates)
    ends = [t.select(F.col(d).alias("doc_id"), F.col(p).alias("place")) for t, d, p in ((pairs, "a_doc", "a_place"), (pairs, "b_doc", "b_place"), (large, "doc_id", "place"))]
    sets, path = _tokens(named, ends[0].union(ends[1]).union(ends[2]))
    paths.append(path)
    pairs, path = written(_close(pairs, sets, rate), "close")
    paths.append(path)
    removed(spark, pairs_path)
    sets = sets.drop(*PARITIES)
    # the nearest earlier line first; of those that it doesn't settle, all; last, those that have more in a key of many
    nearest = pairs.groupBy("b_doc", "b_place").agg(F.min(F.struct("far", "a_doc", "a_place")).alias("n")).select("n.a_doc", "n.a_place", "b_doc", "b_place")
    similar, path = written(_verified(nearest, sets, rate), "later")
    paths.append(path)
    settled = similar.select(F.col("doc_id").alias("b_doc"), F.col("place").alias("b_place"))
    rest, path = written(pairs.join(settled, ["b_doc", "b_place"], "left_anti"), "rest")
    paths.append(path)
    some = sets
    if rest.count() <= FEW:  # then their lines are picked out before any tokens are moved
        some = sets.join(F.broadcast(rest.select(F.explode(F.array(F.struct(F.col("a_doc").alias("doc_id"), F.col("a_place").alias("place")), F.struct(F.col("b_doc").alias("doc_id"), F.col("b_place").alias("place")))).alias("l")).select("l.*").distinct()), LINE, "left_semi")
    others, path = written(_verified(rest, some, rate), "later")
    paths.append(path)
    similar = similar.union(others)
    waiting = stars.filter("a_doc is null").select(F.col("b_doc").alias("doc_id"), F.col("b_place").alias("place")).distinct().join(similar, LINE, "left_anti")
    similar = similar.union(_match_earlier(waiting, large, sets, rate))
    gone, _ = written(same.union(similar).groupBy("doc_id").agg(F.collect_set("place").alias("places")), "gone")
    for path in paths:
        removed(spark, path)
    shared.unpersist()
    return gone


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns that are there, and n_lines, n_removed and kept_text."""
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            data, start, stop, row, _, listed = _cut(part, "_gone_places")
            valid = part.column("text").is_valid()
            stay = np.flatnonzero(~listed)
            more = np.zeros(len(stay), bool)  # another line of its row stays after it
            more[:-1] = row[stay[1:]] == row[stay[:-1]]
            until = stop[stay] + more
            edge = np.zeros(len(data) + 1, np.int8)
            np.add.at(edge, start[stay], 1)
            np.add.at(edge, until, -1)
            text = data[np.cumsum(edge[:-1]) > 0]
            size = np.bincount(row[stay], weights=until - start[stay], minlength=part.num_rows).astype(np.int64)
            cuts = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
            kept = pa.LargeStringArray.from_buffers(part.num_rows, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(text)))
            kept = pa.compute.if_else(valid, kept, pa.scalar(None, pa.large_string())).cast(pa.string())
            lines = np.bincount(row, minlength=part.num_rows) * valid.to_numpy(zero_copy_only=False)
            columns = [(n, c) for n, c in zip(part.schema.names, part.columns) if n not in ("tag", "_gone_places")]
            new = [("n_lines", pa.array(lines, pa.int64())), ("n_removed", pa.array(np.bincount(row, weights=listed, minlength=part.num_rows).astype(np.int64))), ("kept_text", kept)]
            yield pa.RecordBatch.from_arrays([c for _, c in columns + new], names=[n for n, _ in columns + new])


def _without(docs: DataFrame, similarity: float) -> DataFrame:
    """docs (with any columns but tag, n_lines, n_removed and kept_text) with n_lines, n_removed and kept_text."""
    rate = Fraction(str(similarity))
    if not Fraction(3, 4) <= rate < 1:
        raise ValueError("similarity is 0.75 at least and below 1")
    tagged = docs.withColumn("tag", F.coalesce(F.hash("text"), F.lit(0)))
    gone = _gone(tagged.filter("doc_id is not null").select("doc_id", "text", "tag"), rate)
    gone = gone.select(F.col("doc_id").alias("_gone_doc"), F.col("places").alias("_gone_places"))
    rows = tagged.join(gone, F.col("doc_id") == F.col("_gone_doc"), "left").drop("_gone_doc").withColumn("_gone_places", F.coalesce("_gone_places", F.array().cast("array<bigint>")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.mapInArrow(_kept, f"{kinds}, n_lines long, n_removed long, kept_text string")


def remove_similar_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """doc_id, n_lines, n_removed and kept_text of every row of docs.

    A line is the set of its tokens (words, A-Z in lower case).  It is removed if an earlier line, by doc_id and
    then place, has a Jaccard similarity of at least `similarity` with it, judged on the input; blank lines stay.
    kept_text: the other lines, with line ends between.

    1. Tokens are counted over all documents, in a fixed number of buckets.
    2. Each set emits the rarest of its composite tokens as keys (the prefix; see Rule), rarity being that of the
       tokens together.  A composite with a token that occurs once is no key.  Every line emits its set's id, which
       is aggregated to the first line of each set; lines of equal sets (by 128 bits) go but for the first.
    3. Sets that share a key pass the length and positional filters, and a bound on how many tokens differ (from 64
       parity bits of each set), and become pairs.  Of a key with more than GROUP sets, those with more than CLOSE such
       pairs, and of one with more than CROWD all, are lines compared with the first GROUP ones, and the nearest become
       pairs; those that match none of these, and may match others, are compared with all earlier lines of the key
       among them, in a join by key and size that skew handling can split.
    4. Pairs are compared by more parity bits, and what is left is verified on all tokens, by 64-bit hashes.

    A null text stays null and has no lines.  A row without a doc_id is returned as it is.  Rows that repeat a
    doc_id are ordered by a hash of their texts; of rows with the same text too, each keeps the same lines.
    Empty docs: an empty result.  Other columns of docs are not read.
    """
    return _without(docs.select("doc_id", "text"), similarity).select("doc_id", "n_lines", "n_removed", "kept_text")


def without_similar_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """docs (columns of documents) with the text that is kept and n_chars to match; those left without a word are dropped.

    A document that had no word to begin with stays, and so do rows without a doc_id or text.  See remove_similar_lines().
    """
    extra = {c: f"_own_{c}" for c in ("tag", "n_lines", "n_removed", "kept_text") if c in docs.columns}
    found = _without(docs.withColumnsRenamed(extra), similarity).withColumn("_changed", F.col("n_removed") > 0)
    found = found.filter(~F.col("_changed") | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("kept_text"), "n_chars": F.when(F.col("_changed"), F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*(new[c].alias(c) if c in new else F.col(extra.get(c, c)).alias(c) for c in docs.columns))
