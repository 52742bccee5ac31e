"""The other operators against plain versions, and their edge cases."""

import hashlib
import pathlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldloom.llm import ann, chat, decontam, graph, langid, licenses, simhash, substrings


def texts(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(words) for _ in range(rng.choice([11, 13, 16, 30]))] for _ in range(6)]
    rows = []
    for d in rng.sample(range(1000), n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randint(1, 25))]
        rows.append((d, rng.choice([" ", "\n", "  "]).join(parts)))
    rows += [(2000 + i, rows[i][1]) for i in range(5)] + [(3000, "the " * 40), (3001, "the " * 40), (3002, None), (3003, ""), (None, rows[0][1])]
    return rows


def docs_of(spark, rows):
    return spark.createDataFrame([(a, b, 7, 7) for a, b in rows], "doc_id long, text string, tag long, spans long").repartition(5)


def plain_repeats(rows, k=13):
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in split:
        for i in range(len(w) - k + 1):
            if d is not None:
                g = tuple(w[i : i + k])
                first[g] = min(first.get(g, d), d)
    out = []
    for d, w in split:
        gone = {j for i in range(len(w) - k + 1) if d is not None and first[tuple(w[i : i + k])] < d for j in range(i, i + k)}
        out.append((d, len(w), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def test_substrings(spark):
    for seed in (1, 2):
        rows = texts(seed)
        got = [(r["doc_id"], r["n_words"], r["kept_text"]) for r in substrings.remove_repeats(docs_of(spark, rows)).collect()]
        assert sorted(got, key=str) == plain_repeats(rows)
    assert substrings.remove_repeats(docs_of(spark, [])).count() == 0


def test_fingerprint_and_components(spark):
    def plain(text):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        w = [x.lower() for x in w]
        grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = texts(3, 40)
    base = " ".join(f"w{i}" for i in range(400))
    rows += [(4000 + i, base.replace(f"w{50 * i + 9} ", "zz ")) for i in range(7)]
    prints = {(d, t): plain(t) for d, t in rows}
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[rows[i]] ^ prints[rows[j]]).bit_count() <= 2 and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    least = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    want = sorted(((d, prints[d, t], least.get(g)) for (d, t), g in zip(rows, group)), key=str)
    got = simhash.near_duplicates(docs_of(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=str) == want
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_links_of_each_radius(spark):
    rng = random.Random(8)
    prints = {6, 7, 4, 3, -1, -2, -4} | {rng.getrandbits(8) | 1 << 62 for _ in range(60)}
    table = spark.createDataFrame([(x,) for x in prints], "fp long")
    for radius in (0, 2):
        near = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) % 2**64).bit_count() <= radius]
        want = graph.components(spark.createDataFrame(near, "a long, b long"))
        got = graph.components(simhash.links(table, radius))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError):
        simhash.links(table, 1)


def test_one_of_each_near_duplicate(spark):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 40, 200, 600])))) for i in range(0, 400, 2)]
    for d, text in rng.sample(rows, 60):  # copies with a few words changed, in other lines and case
        for j in range(rng.randint(1, 3)):
            words = text.split()
            for _ in range(rng.choice([0, 1, 2, 3, len(words) // 60])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((1000 + len(rows), rng.choice([" ", "\n"]).join(words).upper()))
    rows += [(5000, ""), (5001, None), (5002, " \n"), (None, rows[0][1]), (None, rows[0][1]), (0, rows[0][1]), (3, rows[2][1]), (3, "quite another text"), (6000, "long " * 30_000)]

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, tag long, node string").repartition(4)
    kept = [(r["doc_id"], r["text"]) for r in simhash.one_of_each(docs).collect()]
    named = [(d, shingles(t)) for d, t in rows if d is not None]
    alike = lambda a, b: a == b or (len(a & b) >= 0.8 * len(a | b) - 1e-9 if a | b else True)
    gone = {(d, t) for d, t in rows if d is not None} - set(kept)
    for d, t in gone:  # nothing goes but for an earlier text that it is like, or like one that is
        assert any(e != d and alike(shingles(t), s) for e, s in named)
    left = [(d, shingles(t)) for d, t in kept if d is not None]
    still = [(a, b) for i, (a, x) in enumerate(left) for b, y in left[:i] if a != b and alike(x, y) and (len(x & y) >= 0.9 * len(x | y) or x == y)]
    assert not still
    assert len(kept) + len(gone) == len(rows) and sum(d is None for d, _ in kept) == 2 and (3, "quite another text") in kept and (0, rows[0][1]) in kept
    assert {5000, 5001, 5002} & {d for d, _ in kept} == {5000}
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1000 for i in range(1000, 1300)}}


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 12))
    x[1000:1900] = x[7] + 1e-3 * rng.normal(size=(900, 12))
    x[2000:2040] = x[3]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(3, [float(v) for v in x[3]]), (9000, None), (9001, [0.0] * 12), (9002, [float("nan")] * 12), (None, [1.0] * 12), (9003, [1.0, None]), (9004, [3.0, 4.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.neighbours(table, table.filter("vec_id % 50 = 0 or vec_id in (3, 9004)"), k=10, shard_rows=1000).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    hit = n = 0
    for q in [*range(0, 3000, 50), 3]:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = sorted((d[i], i) for i in range(3000) if i != q)[:10]
        hit += len({i for _, i in want} & {i for _, i in by[q]})
        n += 10
        assert by[q] == sorted(by[q])
    assert hit / n >= 0.95
    assert [i for _, i in by[3]] == list(range(2000, 2010))
    assert 9004 not in by
    assert ann.neighbours(table.limit(0), table, k=3).count() == 0


def test_no_edge_that_pruning_removes(spark):
    x = np.random.default_rng(3).normal(size=(700, 8))
    g = ann.Graph(x, degree=24, alpha=1.2)
    p = g.points.astype(float)
    for i in range(0, 700, 7):
        kept = [j for j in g.edges[i] if j >= 0]
        to = [((p[i] - p[j]) ** 2).sum() for j in kept]
        assert to == sorted(to) and len(kept) == len(set(kept)) and i not in kept
        for b in range(len(kept)):
            for a in range(b):
                assert 1.2**2 * ((p[kept[a]] - p[kept[b]]) ** 2).sum() > to[b] * (1 - 1e-4)


@pytest.mark.parametrize("offset, scale", [(1e6, 1.0), (0.0, 1e30), (0.0, 1e-30)])
def test_graph_of_offset_and_huge_vectors(offset, scale):
    x = np.random.default_rng(4).normal(size=(1500, 10)) * scale + offset
    found, _ = ann.Graph(x).search(x[::30], 64)
    hit = sum(len(set(np.argsort(((x / scale - x[q] / scale) ** 2).sum(axis=1))[:10]) & set(f[:10])) for q, f in zip(range(0, 1500, 30), found))
    assert hit >= 0.95 * 500


def test_chat_windows(spark):
    said = "</s>[INST] ok [/INST]"
    hard = ["a\\b", "<|im_end|>", "<\\|im_end|>", said, "", "\\", "<<SYS>>\n<</SYS>>", "<s>", "<<s>"]
    rows = [(1, i, "system" if i == 0 else ("user", "assistant")[i % 2 - 1], hard[i % len(hard)] + " word" * (i * 3)) for i in range(12)]
    rows += [(2, 0, None, None), (3, 0, "system", "only"), (4, 0, "user", "x " * 900), (4, 1, "assistant", "y"), (None, 1, "us\ner\\L", "t"), (5, 1, "user", "b"), (5, 1, "user", "a")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    made = chat.windows(table, budget=60, history_budget=30)
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    for conv in {r[0] for r in rows}:
        turns = [(r or "", t or "") for c, n, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1], x[2] or "", x[3] or ""))]
        text = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(t for r, t in turns if r == "assistant")
        g = got[conv]
        assert (g["n_turns"], g["turns_sha256"]) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (g["loss_chars"], g["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    windows = [r for r in made.collect() if r["conv_id"] == 1]
    assert len(windows) > 2 and all(chat.parse(w["formatted"])[0][0] == "system" for w in windows)
    assert all(w["tokens"] <= 60 or w["over_budget"] for w in windows)
    assert chat.windows(table.limit(0)).count() == 0


def plain_language(train, texts):
    """Language and score of each text, from counts made word by word."""
    letters = lambda t: "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
    langs = sorted({x for _, x in train})
    counts = {(n, x): {} for n in range(6) for x in langs}
    for text, lang in train:
        for w in letters(text):
            for n in range(6):
                for g in [w] if n == 0 else [f"<{w}>"[i : i + n] for i in range(len(w) + 3 - n)]:
                    counts[n, lang][g] = counts[n, lang].get(g, 0) + 1
    known = [set().union(*(counts[n, x] for x in langs)) for n in range(6)]
    log = lambda n, g, x: np.log((counts[n, x].get(g, 0) + 0.5) / (sum(counts[n, x].values()) + 0.5 * max(len(known[n]), 1)))
    out = []
    for text in texts:
        total = dict.fromkeys(langs, 0.0)
        for w in letters(text):
            for n in (0, 5, 4, 3, 2, 1):
                found = [g for g in ([w] if n == 0 else [f"<{w}>"[i : i + n] for i in range(len(w) + 3 - n)]) if g in known[n]]
                if found:
                    for x in langs:
                        total[x] += np.mean([log(n, g, x) for g in found])
                    break
        best = max(langs, key=lambda x: (total[x], -langs.index(x)))
        out.append((best, 1 / sum(np.exp(total[x] - total[best]) for x in langs)) if letters(text) else ("und", 0.0))
    return out


def test_language(spark):
    rng = random.Random(1)
    own = {"xx": ["alba", "bela", "cila", "dola"], "yy": ["krun", "strom", "prag", "wulk"]}
    rows = [(i, " ".join(rng.choices(own[lang], k=12)), lang) for i in range(60) for lang in [rng.choice(["xx", "yy"])]]
    rows += [(100, None, "xx"), (101, "123 !?", "yy"), (102, "", None), (None, "alba bela", "xx"), (103, "strombul krunwulk", None), (104, "½ ² ① Ⅳ", None), (105, "1½alba2", None)]
    rows += [(106, "Alba, PRAG ALB zzz ﬁ İx", None), (106, "Alba, PRAG ALB zzz ﬁ İx", None), (107, "alba krun", None), (108, "strom " * 50_000, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(table.withColumnRenamed("lang", "lang_pred"), langid.train(table)).collect()
    want = plain_language([(t, x) for d, t, x in rows if d is not None and x and t is not None], [t for _, t, _ in rows])
    key = lambda r: (r[0] is None, r[0] or 0)
    for r, (d, (lang, score)) in zip(sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in got), key=key), sorted(zip([r[0] for r in rows], want), key=key)):
        assert (r[0], r[1]) == (d, lang) and abs(r[2] - score) < 1e-4
    assert dict(zip([r[0] for r in rows], want))[104] == ("und", 0.0) and {r["lang_pred"] for r in got if r["doc_id"] in (101, 102, 104)} == {"und"}
    none = langid.train(table.limit(0))
    assert {r["lang_pred"] for r in langid.predict(table, none).collect()} == {"und"}


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out()))
    found = langid.predict(docs.filter(langid.held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()), model).filter("lang_pred != 'und'")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 200 and right > 0.98


def test_licenses(spark):
    mit = dict((b, a) for a, b in reversed(licenses.KNOWN))
    whole = next(t for i, t in licenses.KNOWN if i == "ISC")
    rows = [(1, "Copyright (c) 2019 Someone\n\n" + whole.upper().replace(".", " .")), (2, "x\nReleased  under the MIT Licence!\nx"), (3, None), (4, ""), (None, "Released under the MIT License."), (2, "y")]
    got = sorted(((r["doc_id"], r["license_id"], r["line_licenses"], r["n_license_lines"]) for r in licenses.scan(docs_of(spark, rows), licenses.catalog(spark)).collect()), key=str)
    assert got == sorted([(1, "ISC", "ISC", 1), (2, None, "MIT", 1), (3, None, "", 0), (4, None, "", 0), (None, "MIT", "MIT", 1), (2, None, "", 0)], key=str)
    assert mit and licenses.scan(docs_of(spark, []), licenses.catalog(spark)).count() == 0


def test_whole_licences_in_other_dress(spark):
    bodies = {i: t for i, t in licenses.KNOWN if len(t) > 300}
    rows, want = [], {}
    for n, (i, t) in enumerate(sorted(bodies.items())):
        for k, title in enumerate(("", *licenses.TITLES.get(i, ()))):
            dressed = f"{title}\n\nCopyright (c) <holders>\n  (C) 2011-2020 A. Body\nAll rights reserved.\n\n" + t.replace(". ", ".\n\n   ").replace('"', "``").swapcase()
            rows += [(100 * n + k, dressed), (100 * n + k + 50, dressed + " But not for you.")]
            want |= {100 * n + k: i, 100 * n + k + 50: None}
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan(docs_of(spark, rows), licenses.catalog(spark)).collect()}
    assert got == want and len(bodies) >= 7


def test_long_licences_by_digest(spark):
    files = {"GPL-3.0": "GPL-3", "GPL-2.0": "GPL-2", "MPL-2.0": "MPL-2.0", "Apache-2.0": "Apache-2.0"}
    folder = pathlib.Path("/usr/share/common-licenses")
    rows = [(k, (folder / f).read_text().upper().replace(",", " , ")) for k, f in enumerate(files.values()) if (folder / f).exists()]
    if not rows:
        pytest.skip("no licence texts here")
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan(docs_of(spark, rows), licenses.catalog(spark)).collect()}
    assert got == {k: list(files)[k] for k, _ in rows}


def test_decontamination(spark):
    item = "A farmer called Tom has 5 apples and Mary has 3 pears, so how many fruits do Tom and Mary have together now?"
    other = "Nothing of the kind is asked here, where only plain words of a quiet tale go by one after another."
    again = item.replace("Tom", "Anna").replace("Mary", "Zoe").replace("5", "12").replace("3", "40")
    broken = again.replace("Anna and Zoe", "Carl and Zoe")
    rows = [(1, f"Before. {item} After."), (2, f"Before. {again} After."), (3, f"Before. {broken} After."), (4, other), (5, None), (6, ""), (None, item), (7, item[:40])]
    items = spark.createDataFrame([(1, item, 0), (2, "too short", 0), (None, other, 0), (3, None, 0)], "item_id long, text string, h int")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs_of(spark, rows), items).collect())
    assert got == [(1, 1), (2, 1)]
    assert sorted(str(r["doc_id"]) for r in decontam.decontaminated(docs_of(spark, rows), items).collect()) == ["3", "4", "5", "6", "7", "None"]
    assert decontam.contaminated(docs_of(spark, []), items).count() == 0
    assert decontam.contaminated(docs_of(spark, rows), items.limit(0)).count() == 0


def test_decontamination_of_rows_that_repeat_an_id(spark):
    item = "A farmer called Tom has 5 apples and Mary has 3 pears, so how many fruits do Tom and Mary have together now?"
    again = item.replace("Tom", "Anna").replace("5", "12")
    rows = [(1, item), (2, item), (2, again), (2, again), (3, "a clean text"), (3, again + " word" * 30_000)]
    items = spark.createDataFrame([(1, item, "x")], "item_id long, text string, doc_tag string")
    docs = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, at long, s long")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()) == [(1, 1), (2, 1), (3, 1)]
    assert [tuple(r) for r in decontam.decontaminated(docs, items).collect()] == [(3, "a clean text", 1, 2)]


def test_decontamination_of_names_at_sentence_starts_and_equal_numbers(spark):
    item = "Tom has 5 apples. Mary buys 3 pears. Tom eats 2 of them. How many are left?"
    other = "A farmer called Tom has 5 apples and Mary has 3 pears, so how many fruits do Tom and Mary have together now?"
    fours = other.replace("Tom", "Anna").replace("Mary", "Zoe").replace("5", "4").replace("3", "4")
    twice = "A box holds 5 red balls and another box holds 5 green balls, so how many of them are there in all?"
    rows = [
        (1, item), (2, item.replace("Tom", "Anna").replace("Mary", "Zoe").replace("5", "9").replace("3", "8").replace("2", "7")),
        (3, item.lower()), (4, fours), (5, twice.replace("5 red", "4 red").replace("5 green", "6 green")),
        (6, fours.replace("Anna and Zoe", "Carl and Zoe")), (7, fours.replace("Zoe", "Anna")), (8, "Then " + item.replace("Tom", "Zoe")),
        (9, "Nobody has any apples. Mary sells pears. Someone eats one of those. What can be left?"),
    ]
    items = spark.createDataFrame([(1, item), (2, other), (3, twice)], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs_of(spark, rows), items).collect())
    assert got == [(1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (8, 1)]
