"""Substring dedup by seed and extend: winnowed anchors, extended both ways to maximal repeats."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import removed, written
from .words import RunHash, Words, mix, raw, signed, slices

#: Words in an anchor.
PAIR = 2


class Anchors:
    """The anchors of a text column, and the runs of windows that chose each.

    A window of so many words chooses the last of its word pairs that has the most bytes and, among those, the
    smallest hash.  The choice depends on the window's words alone, so that two documents that share a window
    share its anchor too.  run: for each, the row, the anchor's hash, the first window's first word (counted
    in the row), how many windows, and the hash of all words that these windows cover.
    """

    def __init__(self, column: pa.Array, window: int):
        w = self.words = Words(column)
        h = w.hash
        n = len(h)
        self.window = window
        room = np.repeat(w.first[1:], w.counts) - np.arange(n) if n else np.zeros(0, np.int64)
        valid = np.flatnonzero(room >= window)
        if not len(valid):
            self.row = self.at = self.many = np.zeros(0, np.int64)
            self.anchor = self.context = np.zeros(0, np.uint64)
            self.begin = np.zeros(0, np.int64)
            return
        size = w.ends - w.starts
        pairs = n - PAIR + 1
        gram = mix(h[:pairs] * np.uint64(0xD6E8FEB86659FD93) + h[1 : pairs + 1])
        order = ((np.uint64(255) - np.minimum(size[:pairs] + size[1 : pairs + 1], 255).astype(np.uint64)) << np.uint64(56)) | (gram >> np.uint64(8))
        best = np.arange(pairs)
        need, have = window - PAIR + 1, 1
        while have < need:  # twice as wide each time; the last step overlaps
            step = min(have, need - have)
            left, right = best[: len(best) - step], best[step:]
            best = np.where(order[right] <= order[left], right, left)
            have += step
        chosen = best[valid]
        edge = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        self.begin = valid[edge]
        self.many = np.diff(np.append(edge, len(valid)))
        at = chosen[edge]
        self.row = np.searchsorted(w.first, self.begin, side="right") - 1
        self.at = self.begin - w.first[self.row]
        self.anchor = gram[at]
        self.runs = RunHash(h)
        self.context = mix(self.runs.of(self.begin, self.begin + self.many + window - 1) + (at - self.begin).astype(np.uint64))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For these runs: the run, the first word in the row and the hash of each of its windows."""
        run = np.repeat(which, self.many[which])
        many = self.many[which]
        step = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
        first = self.begin[run] + step
        return run, self.at[run] + step, self.runs.of(first, first + self.window)


def _batch(**columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c) for c in columns.values()], names=list(columns))


def _ids(part: pa.RecordBatch) -> np.ndarray:
    return part.column("doc_id").to_numpy(zero_copy_only=False)


def _anchor_counts(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found, n = np.unique(signed(Anchors(part.column("text"), window).anchor), return_counts=True)
            yield _batch(anchor=found, n=n)


def _anchor_places(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            a = Anchors(part.column("text"), window)
            yield _batch(anchor=signed(a.anchor), doc_id=_ids(part)[a.row], at=a.at)


def _wanted(part: pa.RecordBatch, column: str, a: Anchors, tagged: bool) -> np.ndarray:
    """The runs that start at a place in this list of the row: places, with the text's tag above if tagged."""
    lists = part.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
    if tagged:
        same = (flat >> 32) == part.column("tag").to_numpy(zero_copy_only=False)[row]
        flat, row = flat[same] & 0xFFFFFFFF, row[same]
    wide = 1 << 32
    return np.flatnonzero(np.isin(a.row * wide + a.at, row * wide + flat))


def _contexts(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            a = Anchors(part.column("text"), window)
            k = _wanted(part, "places", a, False)
            row = a.row[k]
            tag = part.column("tag").to_numpy(zero_copy_only=False)[row].astype(np.int64)
            yield _batch(anchor=signed(a.anchor[k]), context=signed(a.context[k]), doc_id=_ids(part)[row], place=(tag << 32) | a.at[k], many=a.many[k].astype(np.int32))


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            a = Anchors(part.column("text"), window)
            run, at, hashed = a.windows(_wanted(part, "places", a, True))
            row = a.row[run]
            tag = part.column("tag").to_numpy(zero_copy_only=False)[row].astype(np.int64)
            yield _batch(anchor=signed(a.anchor[run]), hashed=signed(hashed), doc_id=_ids(part)[row], place=(tag << 32) | at)


def _kept(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "repeats", "kept_text"]
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        for part in slices(batch):
            data, offsets = raw(part.column("text"))
            data, offsets = memoryview(data), offsets.tolist()
            n_words, repeats, kept = [], [], []
            spans = part.column("spans").to_pylist()
            tags = part.column("tag").to_pylist()
            for i, found in enumerate(spans):
                words = bytes(data[offsets[i] : offsets[i + 1]]).split()
                n_words.append(len(words))
                found = [(x["place"] & 0xFFFFFFFF, x["many"]) for x in found or () if x["place"] >> 32 == tags[i]]
                if not found:
                    repeats.append([])
                    kept.append(b" ".join(words))
                    continue
                change = np.zeros(len(words) + 1, np.int64)
                at, many = np.array(found, np.int64).T
                np.add.at(change, at, 1)
                np.add.at(change, at + many + window - 1, -1)
                stays = np.cumsum(change[:-1]) == 0
                turn = np.diff(np.concatenate(([1], stays.astype(np.int8), [1])))
                repeats.append([{"start": a, "end": b} for a, b in zip(np.flatnonzero(turn < 0).tolist(), np.flatnonzero(turn > 0).tolist())])
                kept.append(b" ".join(compress(words, stays.tolist())))
            yield pa.record_batch([part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(repeats, pa.list_(span)), pa.array(kept, pa.binary()).cast(pa.string())], names=names)


KEPT = "doc_id long, n_words long, repeats array<struct<start:long,end:long>>, kept_text string"


def remove_repeats(docs: DataFrame, min_words: int = 13) -> DataFrame:
    """doc_id, n_words, repeats and kept_text of every row of docs (columns doc_id and text are read).

    repeats: the maximal spans of words (start, end) covered by windows of min_words words whose word
    sequence also starts in a document with a smaller doc_id, judged on the input.  kept_text: the other
    words, joined by one space.

    1. Seeds: every window chooses an anchor among its word pairs by its own words.  Anchors that occur once
       are done with (an aggregate, combined before the shuffle, then a join that skew handling can split).
    2. Extension: around each shared anchor, the windows that chose it are compared as a whole, by a hash of
       all their words; where a document with a smaller id has the same, the whole run repeats.
    3. Only where an anchor is in different surroundings are single windows compared, one document for each.
    Each step's rows are written to the shared folder, so that its shuffle files don't add up.
    No pairs are made: the smallest doc_id of an equal group is enough, so that copies cost one row each.
    Windows are equal by 128 bits of hash (the anchor's and the window's).

    A null text counts as empty.  A row with a null doc_id is returned as it is, neither smaller nor larger than
    others.  Rows that repeat a doc_id belong to one document, each with its own result.
    Empty docs: an empty result.
    """
    w = min_words
    if w < PAIR + 1:
        raise ValueError(f"min_words is {PAIR + 1} at least")
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce(F.hash("text"), F.lit(0)).alias("tag"))
    named = rows.filter("doc_id is not null")
    texts = named.select("doc_id", "text")
    shared = texts.mapInArrow(lambda it: _anchor_counts(it, w), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")
    places = texts.mapInArrow(lambda it: _anchor_places(it, w), "anchor long, doc_id long, at long")
    seeds, seeds_path = written(places.join(shared, "anchor").groupBy("doc_id").agg(F.collect_list("at").alias("places")), "seeds")
    runs, runs_path = written(named.join(seeds, "doc_id").mapInArrow(lambda it: _contexts(it, w), "anchor long, context long, doc_id long, place long, many int"), "runs")
    removed(spark, seeds_path)
    same, same_path = written(runs.groupBy("anchor", "context").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")), "contexts")
    several = same.groupBy("anchor").agg(F.count("*").alias("contexts")).filter("contexts > 1").select("anchor", F.lit(True).alias("mixed"))
    judged = runs.join(same.join(several, "anchor", "left").filter("least < most or mixed"), ["anchor", "context"])
    judged, judged_path = written(judged.filter("least < doc_id or mixed").select("doc_id", "place", "many", (F.col("least") < F.col("doc_id")).alias("gone")), "judged")
    removed(spark, runs_path)
    removed(spark, same_path)
    edges = judged.filter("not gone").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    windows, windows_path = written(named.join(edges, "doc_id").mapInArrow(lambda it: _windows(it, w), "anchor long, hashed long, doc_id long, place long"), "windows")
    least = windows.groupBy("anchor", "hashed").agg(F.min("doc_id").alias("least"))
    single = windows.join(least, ["anchor", "hashed"]).filter("least < doc_id").select("doc_id", "place", F.lit(1).alias("many"))
    whole = judged.filter("gone").select("doc_id", "place", "many")
    spans, _ = written(whole.union(single).groupBy("doc_id").agg(F.collect_list(F.struct("place", "many")).alias("spans")), "spans")
    removed(spark, windows_path)
    removed(spark, judged_path)
    found = named.join(spans, "doc_id", "left").mapInArrow(lambda it: _kept(it, w), KEPT)
    rest = rows.filter("doc_id is null").withColumn("spans", F.lit(None).cast("array<struct<place:long,many:int>>")).mapInArrow(lambda it: _kept(it, w), KEPT)
    return found.union(rest)
