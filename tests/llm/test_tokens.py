"""Token ids, their files, and packing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldloom.llm import packing, simple8b
from fieldloom.llm.shared import BATCH_BYTES, written
from fieldloom.llm.tokens import Encoder

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ENCODERS = {f: Encoder(public_tokenizers.path(f)) for f in FILES}
HARD = ["", " ", "\n", "a  b", " a", "a ", "a\n\nb", "a \n b", "a\tb c", "don't  stop now", "Été ́x", "x\x1cy z", "<|endoftext|> a <|endoftext|>", "a \t b\tc", "12 345\n6", "こん にち\nは", "a b c", "\r\na b\r\n"]


def ids_of(path, text):
    t = Tokenizer.from_file(public_tokenizers.path(path))
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", FILES)
def test_pieces_give_the_ids_of_the_whole_text(path):
    ids, sizes = ENCODERS[path].encode_column(pa.array(HARD))
    cuts = np.cumsum(sizes)
    assert [x.tolist() for x in np.split(ids, cuts[:-1])] == [ids_of(path, x) for x in HARD]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB \n\t's1.é ́\x1c ")), max_size=30))
def test_pieces_give_the_ids_of_any_text(text):
    for path in FILES:
        e = ENCODERS[path]
        assert e.encode_column(pa.array([text, "x y", text]))[0].tolist() == [i for x in (text, "x y", text) for i in e.tokenizer.encode(x, add_special_tokens=False).ids]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**32 - 1)), max_size=3000))
def test_simple8b_round_trip(values):
    ids = np.array(values, np.uint32)
    data = simple8b.segment(np.array([5]), np.array([False]), np.array([len(ids)]), ids)
    s = simple8b.Segment(data)
    assert s.ids().tolist() == values
    for i in range(len(s.first)):
        assert s.block(i).tolist() == values[i * simple8b.BLOCK : (i + 1) * simple8b.BLOCK]


def test_simple8b_packs_zeros_and_small_ids():
    words, *_ = simple8b.pack(np.zeros(960, np.uint32))
    assert len(words) == 4
    words, *_ = simple8b.pack(np.full(1000, 30_000, np.uint32))
    assert len(words) == 250


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        simple8b.Segment(b"xxxx" + bytes(40))


ROWS = [(3, "One two three."), (1, None), (2, ""), (None, "no id"), (7, "a b c " * 3000), (9, "same"), (9, "same"), (10, "x" * 9000)]


def frame(spark, rows):
    return spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, start long, length long")


def test_files_of_ids(spark):
    path = "word_bpe_49k.json"
    docs = frame(spark, ROWS)
    got = sorted(simple8b.token_index(docs, public_tokenizers.path(path)).collect(), key=lambda r: r["start"])
    before, want = 0, []
    for d, text in sorted(ROWS, key=lambda r: -1 if r[0] is None else r[0]):
        ids = [*ids_of(path, text or ""), 1]
        want.append((d, before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        before += len(ids)
    assert [tuple(r) for r in got] == want
    assert simple8b.token_index(docs.limit(0), public_tokenizers.path(path)).count() == 0


def test_ids_read_back(spark, tmp_path):
    path = f"file://{tmp_path}/ids"
    simple8b.write_ids(frame(spark, ROWS[:3]), path, public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: r["ids"] for r in simple8b.read_ids(spark, path).collect()}
    assert got == {d: [*ids_of("word_bpe_49k.json", t or ""), 1] for d, t in ROWS[:3]}


def check_packed(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return sum(packing.slack(sum(x[1] for x in parts), capacity) for parts in sequences.values())


def test_packing_of_documents(spark):
    path = "byte_bpe_50k.json"
    parts = packing.pack(packing.pieces(frame(spark, ROWS), public_tokenizers.path(path), capacity=64), 64)
    rows = parts.collect()
    check_packed(rows, 64)
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append(r)
    for d, text in ROWS:
        ids = [*ids_of(path, text or ""), 1]
        mine = sorted(got[d], key=lambda r: r["start"])
        if d == 9:
            assert len(mine) == 2
            mine = mine[:1]
        assert {r["doc_tokens"] for r in mine} == {len(ids)}
        assert np.frombuffer(b"".join(bytes(r["ids"]) for r in mine), "<u4").tolist() == ids
    assert packing.pack(packing.pieces(frame(spark, ROWS).limit(0), public_tokenizers.path(path))).count() == 0


def test_packing_of_many_lengths(spark):
    rng = random.Random(1)
    lengths = [rng.randint(1, 100) for _ in range(3000)] + [37] * 2000
    rows = [(i, 0, n, n, np.arange(n, dtype="<u4").tobytes()) for i, n in enumerate(lengths)]
    parts = spark.createDataFrame(rows, packing.PIECES).repartition(7)
    rows = packing.pack(parts, 100).collect()
    assert check_packed(rows, 100) < 100
    got = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        assert len(r["ids"]) == 4 * r["length"]
        got[r["doc_id"]] = got.get(r["doc_id"], b"") + bytes(r["ids"])
    assert got == {i: np.arange(n, dtype="<u4").tobytes() for i, n in enumerate(lengths)}


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 4), min_size=1, max_size=6))
def test_fill_is_the_best_with_the_longest(counts):
    taken = packing.fill(dict(counts), 24)
    assert all(counts[k] >= v for k, v in taken.items()) and max(counts) in taken
    total = sum(k * v for k, v in taken.items())
    sums = {max(counts)}
    for k, v in counts.items():
        for _ in range(v - (k == max(counts))):
            sums |= {x + k for x in sums if x + k <= 24}
    top = max(sums)
    powers = [x for x in sums if x & (x - 1) == 0]
    assert total == (top if top == 24 or not packing.slack(top, 24) or not powers else max(powers))


def test_packing_holds_little_at_once():
    path, capacity = public_tokenizers.path("byte_bpe_50k.json"), 2048
    docs = pa.record_batch([pa.array(range(400)), pa.array([f"{i} " * 8000 for i in range(400)])], names=["doc_id", "text"])
    assert docs.nbytes > 8 * packing.SLICE
    parts = list(packing._pieces(iter([docs]), path, 1, capacity))
    assert max(p.nbytes for p in parts) < 6 * packing.SLICE  # four bytes an id, and a digit or two and a blank of text are two ids at most
    whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    n = whole.num_rows
    length = whole.column("length").to_numpy()
    rank = np.array([np.sum(length[:i] == length[i]) for i in range(n)])
    ranked = pa.RecordBatch.from_arrays([*whole.columns, pa.array(rank), pa.array(np.zeros(n, np.int64))], names=[*whole.schema.names, "_pack_rank", "_pack_before"])
    plan = packing.Plan(dict(zip(*(x.tolist() for x in np.unique(length, return_counts=True)))), capacity)
    placed = list(packing._placed(iter([ranked]), plan))
    assert max(p.nbytes for p in placed) < 2 * packing.SLICE < whole.nbytes
    assert sum(map(len, (x.as_py() for p in placed for x in p.column("ids")))) == 4 * int(length.sum())


def test_batches_for_workers_have_few_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes])], names=["n"])

    docs = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) AS text")
    got = [r["n"] for r in written(docs.mapInArrow(sizes, "n long"), "sizes")[0].collect()]
    assert sum(got) > 3000 * 10000 and max(got) < 2 * BATCH_BYTES
