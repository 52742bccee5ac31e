"""Language identification: known words first, then ever shorter character n-grams for unseen words."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import kept, release, slices

UNDETERMINED = "und"
#: Longest and shortest n-gram; a word is taken with a mark at either end.
LONGEST, SHORTEST = 5, 1
#: Vectors of words kept in a worker.
CACHE_WORDS = 200_000


#: Runs of word characters but digits and the underscore: letters, and numbers such as ½.
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """The runs of letters (str.isalpha) of a text in lower case; digits, other numbers, signs and white space separate."""
    found = WORD.findall((text or "").lower())
    if "".join(found).isalpha():
        return found
    return [x for w in found for x in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def digest(order: int, gram: str) -> int:
    """A word (order 0) or n-gram as a number of 64 bits."""
    return xxhash.xxh64_intdigest(gram, order)


COUNTS = "lang int, gram_order int, gram long, n long"


def _counts(batches: Iterator[pa.RecordBatch], langs: list[str]) -> Iterator[pa.RecordBatch]:
    """Counts by language of words (order 0) and n-grams (order n) in each part of a batch."""
    release()
    number = {x: i for i, x in enumerate(langs)}
    for batch in batches:
        for part in slices(batch):
            words: dict[int, Counter] = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                words.setdefault(number[lang], Counter()).update(words_of(text))
            for lang, counted in words.items():
                for order in (0, *range(SHORTEST, LONGEST + 1)):
                    found = counted
                    if order:
                        found = Counter()
                        for word, n in counted.items():
                            for g in grams(word, order):
                                found[g] += n
                    gram = np.fromiter((digest(order, g) for g in found), np.uint64, len(found)).view(np.int64)
                    same = [np.full(len(gram), x, np.int32) for x in (lang, order)]
                    yield pa.record_batch([pa.array(x) for x in (*same, gram, np.fromiter(found.values(), np.int64, len(found)))], names=["lang", "gram_order", "gram", "n"])


class Model:
    """Log frequencies by language of words and n-grams, told apart by 64-bit hashes: all of the sample's, in sorted arrays."""

    def __init__(self, langs: list[str], order: np.ndarray, gram: np.ndarray, counts: np.ndarray):
        """order, gram (see digest()) and counts (a column for each language): a row for each word or n-gram."""
        self.langs = langs
        self.known, self.table = {}, {}
        for n in range(LONGEST + 1):
            k = np.flatnonzero(order == n)
            k = k[np.argsort(gram[k])]
            own = counts[k].astype(np.float64)
            self.known[n] = gram[k]  # smoothed by half a count
            self.table[n] = np.log((own + 0.5) / (own.sum(axis=0) + 0.5 * max(len(k), 1))).astype(np.float32)

    def _rows(self, order: int, items: list[str]) -> np.ndarray:
        """Where these words or n-grams are in the order's table (-1: unknown)."""
        known = self.known[order]
        if not len(known):
            return np.full(len(items), -1)
        asked = np.fromiter((digest(order, x) for x in items), np.uint64, len(items))
        at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        return np.where(known[at] == asked, at, -1)

    def vectors(self, words: list[str]) -> np.ndarray:
        """Each word's log frequency by language: its own if it is known, else the mean over its longest known n-grams."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        at = self._rows(0, words)
        out[at >= 0] = self.table[0][at[at >= 0]]
        left = np.flatnonzero(at < 0)
        for n in range(LONGEST, SHORTEST - 1, -1):
            if not len(left):
                break
            lists = [grams(words[i], n) for i in left.tolist()]
            owner = np.repeat(np.arange(len(left)), [len(x) for x in lists])
            at = self._rows(n, [g for x in lists for g in x])
            owner, at = owner[at >= 0], at[at >= 0]
            many = np.bincount(owner, minlength=len(left))
            some = many > 0
            for j in range(len(self.langs)):
                out[left[some], j] = np.bincount(owner, weights=self.table[n][at, j], minlength=len(left))[some] / many[some]
            left = left[~some]
        return out

    def choose(self, total: np.ndarray) -> tuple[str, float]:
        share = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.langs[best], float(share[best] / share.sum())


class _Scorer:
    """A model with the vectors of words seen so far, so that a batch is scored with array operations."""

    def __init__(self, model: Model):
        self.model = model
        self._empty()

    def _empty(self) -> None:
        self.row: dict[str, int] = {}
        self.vectors = np.zeros((1 << 12, len(self.model.langs)), np.float32)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.row) > CACHE_WORDS:
            self._empty()
        split = [words_of(x) for x in texts]
        if not self.model.langs:
            return [(UNDETERMINED, 0.0)] * len(split)
        flat = [w for words in split for w in words]
        fresh = [w for w in set(flat) if w not in self.row]
        if fresh:
            used = len(self.row)
            while used + len(fresh) > len(self.vectors):
                self.vectors = np.concatenate((self.vectors, np.empty_like(self.vectors)))
            self.vectors[used : used + len(fresh)] = self.model.vectors(fresh)
            self.row.update(zip(fresh, range(used, used + len(fresh))))
        at = np.fromiter(map(self.row.__getitem__, flat), np.int64, len(flat))
        sums = np.zeros((len(at) + 1, len(self.model.langs)))
        np.cumsum(self.vectors[at], axis=0, dtype=np.float64, out=sums[1:])
        ends = np.cumsum([len(x) for x in split])
        begins = ends - [len(x) for x in split]
        return [self.model.choose(t) if w else (UNDETERMINED, 0.0) for w, t in zip(split, sums[ends] - sums[begins])]


def train(docs: DataFrame, rows_per_lang: int = 5_000, seed: int = 7) -> Model:
    """A model from the texts of docs with a lang.

    rows_per_lang bounds the sample that the classifier is fitted on: of each language about so many rows are
    taken, by a hash of doc_id, and all of them where there are fewer.  Every word and n-gram of the sample is in
    the model, which is as large as the sample makes it however large docs is.  Rows without a lang, a text or a
    doc_id are not learned from; rows that repeat a doc_id are taken or left together.  No rows: a model without
    languages, which answers "und" for everything.
    """
    known = docs.filter("lang is not null and text is not null and doc_id is not null").select("doc_id", "lang", "text")
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    langs = sorted(totals)
    if not langs:
        return Model([], np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros((0, 0)))
    steps = 1 << 30
    taken = F.create_map(*(x for lang, n in totals.items() for x in (F.lit(lang), F.lit(min(steps, int(steps * rows_per_lang / n) + 1)))))
    sample = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(steps)) < taken[F.col("lang")]).select("lang", "text")
    counted = sample.mapInArrow(lambda it: _counts(it, langs), COUNTS).groupBy("gram_order", "gram")
    rows = counted.agg(*(F.sum(F.when(F.col("lang") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(langs)))).toArrow()
    order, gram, *counts = (c.to_numpy() for c in rows.columns)
    return Model(langs, order, gram.view(np.uint64), np.stack(counts, axis=1) if len(order) else np.zeros((0, len(langs))))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score (the share of the chosen language, 0 to 1).

    `und` and 0 where the text is null or has no letter.  Words are runs of letters in lower case; where several
    languages are as likely, the first by name is taken.  The model is broadcast; its size is bounded by train()'s sample.  Columns lang_pred and score that
    docs already has are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = f"langid-{uuid.uuid4().hex}"
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept(key, lambda: _Scorer(shared.value))
        for batch in batches:
            for part in slices(batch):
                found = scorer.predict(part.column("text").to_pylist())
                new = [pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*others).schema)
    return docs.select(*others).mapInArrow(run, f"{kinds}, lang_pred string, score double")


def held_out():
    """Whether a document is kept from training: crc32 of its doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
