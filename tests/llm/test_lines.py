"""Line dedup against a comparison of all lines."""

import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa

from fieldloom.llm import lines


def brute(rows, similarity=0.8):
    """Kept text of each row with a doc_id (each once)."""
    before, out = [], {}
    for d, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        kept = []
        for line in (text or "").split("\n"):
            words = frozenset(x.lower() for x in re.findall(r"[^\x20\x09-\x0D]+", line))
            if words and any(min(len(words), len(b)) >= similarity * max(len(words), len(b)) and len(words & b) >= similarity * len(words | b) - 1e-9 for b in before):
                before.append(words)
                continue
            if words:
                before.append(words)
            kept.append(line)
        out[d] = "\n".join(kept) if text is not None else None
    return out


def made(seed, docs=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + [f"rare{i}" for i in range(3000)]
    pool = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 5, 8, 12, 15, 17, 19, 25, 60]))) for _ in range(60)]
    short = vocabulary[:12]
    rows = []
    for d in rng.sample(range(10 * docs), docs):
        text = []
        for _ in range(rng.randint(0, 9)):
            line = rng.choice(pool).split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            if rng.random() < 0.4:
                line = rng.choices(short, k=rng.randint(1, 9))
            if rng.random() < 0.1:
                line = [w.upper() for w in line]
            text.append(" ".join(line))
        rows.append((d, "\n".join(text)))
    return rows + [(-1, None), (-2, ""), (-3, "\n \n"), (-4, "a b c d e f\na b c d e f g\nA b c d e f")]


def run(spark, rows):
    docs = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, tag long, gone long").repartition(5)
    return lines.remove_similar_lines(docs).collect()


def test_as_all_lines_compared(spark):
    for seed in (1, 2):
        rows = made(seed)
        want = brute(rows)
        got = {r["doc_id"]: r["kept_text"] for r in run(spark, rows)}
        assert got == want


def test_keys_with_many_rows(spark, monkeypatch):
    monkeypatch.setattr(lines, "GROUP", 3)
    for nearest in (1, 2):
        monkeypatch.setattr(lines, "NEAREST", nearest)
        rows = made(3)
        assert {r["doc_id"]: r["kept_text"] for r in run(spark, rows)} == brute(rows)


def test_a_large_group_of_lines_that_are_alike(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(30)]
    rows = []
    for d in range(400):  # up to six words changed, so that some match the first, some others only, some none
        line = list(base)
        for i in rng.sample(range(30), rng.randint(0, 6)):
            line[i] = f"x{rng.randrange(60)}"
        rows.append((d, " ".join(line) + "\nsame line here of five\n" + " ".join(line[:4])))
    assert {r["doc_id"]: r["kept_text"] for r in run(spark, rows)} == brute(rows)


def test_every_match_shares_a_key():
    """Pairs at the bound, of all sizes: their rarest composites meet, whatever the counts of tokens."""
    rng = random.Random(4)
    order = np.array([rng.choice([2, 30, 90, 200]) for _ in range(1 << 12)] * (1 << 10), np.uint8)
    for rate in (Fraction(4, 5), Fraction(3, 4), Fraction(9, 10)):
        rule = lines.Rule(rate)
        for size in [*range(1, 130), 400, 1500]:
            common = [f"c{size}x{rng.random()}" for _ in range(size)]
            left = int((1 - rate) / rate * size)
            only = rng.randint(0, left)
            a, b = common + [f"a{i}" for i in range(only)], common + [f"b{i}" for i in range(left - only)]
            s = lines.LineSets(pa.array([" ".join(a), " ".join(b)]))
            found = [set(), set()]
            for sets, key, rank in rule.keys(s, np.ones(2, bool), order, 100):
                for i, k in zip(sets.tolist(), key.tolist()):
                    found[i].add(k)
            assert set(a) == set(b) or found[0] & found[1]


def test_edges(spark):
    rows = [(None, "a b c d e"), (None, None), (5, "x y\n\nx y"), (5, "x y\n\nx y"), (6, "long " * 20000 + "\nx y")]
    got = run(spark, rows)
    assert sorted((r["doc_id"] or -1, r["n_lines"], r["n_removed"]) for r in got) == [(-1, 0, 0), (-1, 1, 0), (5, 3, 1), (5, 3, 1), (6, 2, 1)]
    assert run(spark, []) == []


def test_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5), (3, "a b c\nd e", None, "s", 9), (4, "", "en", "s", 0), (5, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["lang"]) for r in lines.without_similar_lines(docs).collect()}
    assert got == {1: ("a b c", 5, "en"), 3: ("d e", 3, None), 4: ("", 0, "en"), 5: (None, 0, "en")}


def test_packed_keys_come_back_by_part():
    rng = np.random.default_rng(5)
    spots = np.arange(3)
    rows = np.stack((rng.integers(-(2**63), 2**63, 5000), rng.integers(-(2**63), 2**63, 5000), rng.integers(-(2**63), 2**63, 5000), (rng.integers(1, 2**31, 5000) << 16) | rng.integers(0, 2**16, 5000)))
    rows[0, ::7] = rows[0, 0]
    sent = lines._packed(rows, spots)
    assert sum(map(len, sent.column("rows").to_pylist())) == 28 * 5000  # a row as KEYS has 32 bytes and what Spark adds
    sent = sent.select(["part", "rows"])
    found = [[c.to_numpy() for c in b.columns] for b in lines._sorted(iter([sent]), 64, 1 << 20)]
    assert len(found) == 3 * lines.PARTS and all((np.diff(f[0]) >= 0).all() for f in found)
    low = (1 << 48) - 1
    got = sorted(zip(*(np.concatenate(x).tolist() for x in zip(*found))))
    assert got == sorted(zip((rows[0] & low).tolist(), *(x.tolist() for x in rows[1:])))


def test_rows_of_large_keys_are_not_held():
    spots, rng = np.arange(1), np.random.default_rng(6)
    made = [np.stack((np.full(300, 77), np.arange(300) + 300 * i, rng.integers(0, 9, 300), np.full(300, 20 << 16))) for i in range(20)]
    sent = pa.Table.from_batches([lines._packed(m, spots).select(["part", "rows"]) for m in made]).combine_chunks().to_batches()
    found = list(lines._candidates(lines._sorted(iter(sent), 64, 500), Fraction(4, 5), 64))
    assert max(f.num_rows for f in found) <= 600
    assert sorted(x for f in found for x in f.column("x").to_pylist()) == list(range(6000))
    assert {k for f in found for k in f.column("kind").to_pylist()} == {2}


def test_sets_of_a_crowded_key_that_are_not_alike_become_no_rows():
    """A key of 2,000 sets of which few are alike: all pairs that may match, and no row to be joined with its tokens; of sets all alike, rows."""
    rng, rule = np.random.default_rng(8), lines.Rule(Fraction(4, 5))
    bits = rng.integers(-(2**63), 2**63, 2000)
    for i in range(0, 1980, 40):
        bits[i + 1] = bits[i] ^ (1 << (i % 60))
        bits[i + 2] = bits[i] ^ (3 << (i % 60))
    rows = np.stack((np.full(2000, 77), rng.permutation(2000), bits, (rng.integers(9, 30, 2000) << 16) | rng.integers(0, 3, 2000)))
    a, b = np.triu_indices(2000, 1)
    ok = lines._may_match((bits[a], rows[3][a]), (bits[b], rows[3][b]), rule)
    want = {(int(min(x, y)), int(max(x, y))) for x, y in zip(rows[1][a[ok]], rows[1][b[ok]])}
    assert len(want) > 30

    def found(rows):
        batches = [pa.record_batch(list(rows[:, i : i + 300]), names=["key", "x", "y", "place"]) for i in range(0, 2000, 300)]
        table = pa.Table.from_batches(lines._candidates(iter(batches), Fraction(4, 5), 64, 1 << 14))
        pairs, large = (table.filter(pa.compute.equal(table["kind"], k)) for k in (1, 2))
        return set(zip(pairs["x"].to_pylist(), pairs["y"].to_pylist())), large["x"].to_pylist()

    assert found(rows) == (want, [])
    rows[2, :500], rows[3, :500] = 5, 20 << 16
    pairs, large = found(rows)
    assert sorted(large) == sorted(rows[1, :500].tolist()) and not any(x in large and y in large for x, y in pairs)
    assert {p for p in want if not set(p) & set(large)} <= pairs


def test_crowded_keys(spark, monkeypatch):
    """Keys of each kind: all pairs of few, pairs of some or rows of a crowd, and rows of all of more."""
    monkeypatch.setattr(lines, "GROUP", 2)
    monkeypatch.setattr(lines, "CLOSE", 2)
    rows = made(5)
    for crowd in (6, 1 << 14):
        monkeypatch.setattr(lines, "CROWD", crowd)
        assert {r["doc_id"]: r["kept_text"] for r in run(spark, rows)} == brute(rows)
