"""SimHash near-duplicates found by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lines
from .graph import components
from .shared import alike, removed, written
from .words import RunHash, Words, grouped_order, heads, mix, number_batch, raw, release, signed, slices

BITS = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of a text, as an unsigned number.

    A-Z are lower-cased and words joined by one space.  A bit is 1 if it is set in over half the shingles'
    XXH64; repeats count.  Fewer words than a shingle make one shingle; no words make 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    digest = xxhash.xxh64_digest
    if len(words) < shingle:
        hashed = digest(joined, seed)
    else:
        hashed = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist())])
    hashes = np.frombuffer(hashed, np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[i : i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int, seed: int) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        for part in slices(batch):
            data, offsets = raw(part.column("text"))
            data = memoryview(data)
            found = [fingerprint(bytes(data[a:b]), shingle, seed) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.record_batch([part.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and fp (64 bits as a signed long) of each row; a null text counts as empty, and gets 0."""
    return docs.select("doc_id", "text").mapInArrow(lambda it: _fingerprints(it, shingle, seed), "doc_id long, fp long")


def _partitions(df: DataFrame, *by: str) -> DataFrame:
    """df dealt by these columns to as many partitions as shuffles have: small tables, of which each row becomes many."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


VARIANTS = "key long, node long"


def _variants(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """From node and its fingerprints: each part of `width` bits, as it is and with one bit flipped, as a key.

    Of one part of all 64 bits the key is the variant itself; of several, a hash of its number and the variant.
    """
    flips = np.concatenate((np.zeros(1, np.uint64), np.uint64(1) << np.arange(width, dtype=np.uint64)))
    for batch in batches:
        node = batch.column(0).to_numpy()
        prints = np.stack([c.to_numpy().view(np.uint64) for c in batch.columns[1:]], axis=1)
        many = BITS // width
        parts = np.stack([(prints >> np.uint64(width * i)) & np.uint64((1 << width) - 1) for i in range(many)], axis=2).reshape(len(node), -1)
        for i in range(0, len(node), 1 << 11):
            v = parts[i : i + (1 << 11), :, None] ^ flips
            if v.shape[1] > 1:
                v = mix(v + (np.arange(v.shape[1], dtype=np.uint64) << np.uint64(width))[:, None])
            yield number_batch(VARIANTS, v.ravel(), np.repeat(node[i : i + (1 << 11)], v.shape[1] * v.shape[2]))


def _met(batches: Iterator[pa.RecordBatch], chain: bool) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and node: each node of a key with the key's first, and (chain) with the one before; each pair once a batch."""
    key_now, first, last = None, None, None
    for batch in batches:
        key, node = (c.to_numpy() for c in batch.columns)
        if not len(key):
            continue
        new = heads(key)
        new[0] = key[0] != key_now
        run = np.cumsum(new)
        start = np.concatenate(([first if first is not None else 0], node[new]))[run]
        before = np.concatenate(([last if last is not None else 0], node[:-1]))
        key_now, first, last = key[-1], start[-1], node[-1]
        sides = [(start[~new], node[~new])] + ([(before[~new], node[~new])] if chain else [])
        a, b = (np.concatenate(x) for x in zip(*sides))
        a, b = np.minimum(a, b), np.maximum(a, b)
        a, b = a[a != b], b[a != b]
        order = np.lexsort((b, a))
        order = order[heads(a[order]) | heads(b[order])]
        yield number_batch("a long, b long", a[order], b[order])


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs (a, b) of different fingerprints (column fp, distinct) that connect all within the radius: 0 or 2.

    Every fingerprint emits all variants within half the radius, so two within the radius meet at a variant.
    Those that meet at one variant are all within the radius of one another; at most 1 + 64 different
    ones can, so that no group grows with the data, and linking each to the first keeps
    every connection.  The distance of each pair is verified.  (An odd radius has no such middle.)
    """
    if radius not in (0, 2):
        raise ValueError("radius is 0 or 2")
    if radius == 0:  # equal fingerprints are one row
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    variants = _partitions(prints.select("fp", F.col("fp").alias("bits")), "fp").mapInArrow(lambda it: _variants(it, BITS), VARIANTS)
    pairs = variants.repartition("key").sortWithinPartitions("key", "node").mapInArrow(lambda it: _met(it, False), "a long, b long").distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links) of every row of docs.

    Documents with one fingerprint are in one component, those without words too.  Rows may repeat a doc_id;
    a null doc_id is kept, links like any other, and never names a component unless all its members lack one.
    Empty docs: an empty result.  Other columns of docs are not read.
    """
    found, _ = written(fingerprints(docs, shingle, seed), "fingerprints")
    first = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = components(links(first.select("fp"), radius)).withColumnRenamed("node", "fp")
    least = first.join(rooted, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    other = rooted.join(least, "root").select("fp", "component_id")
    named = first.join(other, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return found.join(named, "fp").select("doc_id", "fp", "component_id")


class ShingleSets:
    """The word shingles (A-Z in lower case) of each row of a text column as sets of hashes, row by row and sorted.

    Fewer words than a shingle make one shingle; no words make none.
    """

    def __init__(self, column: pa.Array, shingle: int):
        w = Words(column, lower=True)
        runs = RunHash(w.hash)
        many = np.where(w.counts == 0, 0, np.maximum(w.counts - shingle + 1, 1))
        row = np.repeat(np.arange(len(many)), many)
        start = w.first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        h = runs.of(start, start + np.minimum(shingle, w.counts[row]))
        order = grouped_order(row, h)
        h, row = h[order], row[order]
        once = heads(h) | heads(row)
        self.hash, self.row = h[once], row[once]
        self.size = np.bincount(self.row, minlength=len(many))

    def _sum(self, items: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.size), np.uint64)
        some = np.flatnonzero(self.size)
        if len(some):
            out[some] = np.add.reduceat(items, (np.cumsum(self.size) - self.size)[some])
        return out

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each set."""
        return tuple(mix(self._sum(mix(self.hash + np.uint64(salt))) + self.size.astype(np.uint64)) for salt in (1, 1 << 40))

    def parities(self) -> np.ndarray:
        """64 bits, each flipped by every shingle that falls to it: two sets differ in at least as many shingles as bits."""
        out = np.zeros(len(self.size), np.uint64)
        some = np.flatnonzero(self.size)
        if len(some):
            out[some] = np.bitwise_xor.reduceat(np.uint64(1) << (mix(self.hash) & np.uint64(63)), (np.cumsum(self.size) - self.size)[some])
        return out

    def prefixes(self, order: np.ndarray, rate: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, shingle and rank of the rarest shingles of each set: two that are similar by rate share one of these.

        Of similar sets the smaller lacks at most size * (1 - rate) shingles of either, so that one more is enough in
        any order that is the same for all; order has the code of each bucket.  What occurs once in all is no key.
        """
        p, q = rate.as_integer_ratio()
        code = order[lines._buckets(self.hash)]
        sort = np.lexsort((self.hash, code, self.row))  # rows are in order already
        shingle, row, code = self.hash[sort], self.row[sort], code[sort]
        rank = np.arange(len(row)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        keep = (rank <= self.size[row] * (q - p) // q) & (code != 1)
        return row[keep], shingle[keep], rank[keep]


SETS = "doc_id long, tag long, node long, other long"


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            yield number_batch(SETS, part.column("doc_id"), part.column("tag"), *ShingleSets(part.column("text"), shingle).ids())


#: Bytes of text whose shingles are made at once.
SLICE = 1 << 20


def _prefixes(batches: Iterator[pa.RecordBatch], shared, shingle: int, rate: Fraction) -> Iterator[pa.RecordBatch]:
    """The keys of the task's sets as _candidates() of lines reads them: key, set, parities, and size and rank."""
    release()
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            s = ShingleSets(part.column("text"), shingle)
            node, bits = s.ids()[0], s.parities()
            row, key, rank = s.prefixes(shared.value[0], rate)
            yield number_batch(lines.KEYS, key, node[row], bits[row], (s.size[row] << 16) | np.minimum(rank, 0xFFFF))


def _shingles(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            s = ShingleSets(part.column("text"), shingle)
            cuts = np.concatenate(([0], np.cumsum(s.size))).astype(np.int32)
            yield pa.record_batch([pa.array(signed(s.ids()[0])), pa.ListArray.from_arrays(pa.array(cuts), pa.array(signed(s.hash)))], names=["node", "shingles"])


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, shingle: int, rate: Fraction) -> tuple[DataFrame, str]:
    """The pairs (a, b) of nodes whose Jaccard similarity, by all shingles, is high enough; and the path of their table."""
    near, path = written(pairs, "near")
    nodes = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    wanted = sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    lists, lists_path = written(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").mapInArrow(lambda it: _shingles(it, shingle), "node long, shingles array<long>").dropDuplicates(["node"]), "shingles")
    a, b = (lists.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set")) for c in "ab")
    found = written(near.join(a, "a").join(b, "b").filter(alike("a_set", "b_set", rate)).select("a", "b"), "links")
    for x in (path, lists_path):
        removed(docs.sparkSession, x)
    return found


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_met() of rows (key, node, and what they are sorted by)."""
    return _met((b.select(["key", "node"]) for b in batches), True)


def similar_sets(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The shingle sets of docs' rows (SETS; doc_id, text and tag are read), and pairs (a, b) of similar nodes that connect all that are.

    Exact, by a prefix filter: each set emits its rarest shingles (see prefixes()), and two that are similar share one.  Sets of a key
    pass filters by size, rank and parities and become pairs, which are verified by all shingles.  Of a key that more than
    lines.GROUP sets have, each is first paired with the first and the one before; of the others only those are
    compared that the links found so far don't connect, in a join by key and size that skew handling can split.
    """
    spark, rate, paths = docs.sparkSession, Fraction(str(similarity)), []
    p, q = rate.as_integer_ratio()
    rule = lines.Rule(rate)
    sets, _ = written(docs.select("doc_id", "tag", "text").mapInArrow(lambda it: _sets(it, shingle), SETS), "sets")

    def hashes(column: pa.Array) -> tuple[np.ndarray, int]:
        return ShingleSets(column, shingle).hash, len(column)

    shared = spark.sparkContext.broadcast(lines.rarity(docs, hashes))
    once = sets.groupBy("node").agg(F.min(F.struct("doc_id", "tag")).alias("f")).select("f.doc_id", "f.tag").distinct()  # a row of each set
    texts = docs.select("doc_id", "tag", "text").join(once, ["doc_id", "tag"], "left_semi")
    keys = texts.mapInArrow(lambda it: _prefixes(it, shared, shingle, rate), lines.KEYS).repartition("key").sortWithinPartitions("key")
    found, path = written(keys.mapInArrow(lambda it, group=lines.GROUP: lines._candidates(it, rate, group), lines.FOUND), "candidates")
    paths.append(path)
    large, path = written(found.filter("kind = 2").select("key", F.col("x").alias("node"), F.col("y").alias("bits"), F.col("place").alias("info")).distinct(), "large")
    paths.append(path)
    chain = large.repartition("key").sortWithinPartitions("key", F.shiftright("info", 16), "bits", "node").mapInArrow(_chained, "a long, b long")
    links, path = _verified(docs, sets, found.filter("kind = 1").select(F.col("x").alias("a"), F.col("y").alias("b")).union(chain).distinct(), shingle, rate)
    if not large.isEmpty():
        paths.append(path)
        step = F.floor(F.log(F.shiftright("info", 16).cast("double")) / F.log(F.lit(q / p)))
        rows = large.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node")).withColumn("step", step)
        a, b = rows.alias("a"), rows.withColumn("step", F.explode(F.array(F.col("step") - 1, "step", F.col("step") + 1))).alias("b")
        size, rank = (lambda t: F.shiftright(f"{t}.info", 16)), (lambda t: F.col(f"{t}.info").bitwiseAND(0xFFFF))
        room = F.floor((rule.q - rule.p) * (size("a") + size("b")) / F.lit(rule.q + rule.p))
        fits = (q * F.least(size("a"), size("b")) >= p * F.greatest(size("a"), size("b"))) & (F.greatest(rank("a"), rank("b")) <= room)
        fits = fits & (F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits"))) <= room) & (F.col("a.root") != F.col("b.root")) & (F.col("a.node") < F.col("b.node"))
        met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.step") == F.col("b.step")) & fits)
        more, _ = _verified(docs, sets, met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct(), shingle, rate)
        links, _ = written(links.union(more), "links")
    for x in paths:
        removed(spark, x)
    shared.unpersist()
    return sets, links


def one_of_each(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs, with one document of each group of near-duplicates: the one with the smallest doc_id.

    Near-duplicates: texts whose word shingles have a Jaccard similarity of `similarity` at least (all of them, see
    similar_sets()), and whatever is connected by such links.  Texts
    without words are copies of one another.  Rows that repeat the smallest doc_id of a group all stay, as rows
    without a doc_id do; of rows that repeat another doc_id only those with a text of the group go.
    Empty docs: an empty result.
    """
    extra = {"_near_tag"} & set(docs.columns)
    if extra:
        raise ValueError("a column has the name _near_tag")
    named = docs.withColumn("_near_tag", F.coalesce(F.xxhash64("text"), F.lit(0)))
    sets, found = similar_sets(named.filter("doc_id is not null").select("doc_id", "text", F.col("_near_tag").alias("tag")), shingle, similarity)
    roots = components(found)
    rooted = sets.select("doc_id", "tag", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("root", "least")
    drop = rooted.join(least, "root").filter("doc_id > least").select("doc_id", F.col("tag").alias("_near_tag")).distinct()
    return named.join(drop, ["doc_id", "_near_tag"], "left_anti").select(*docs.columns)
