"""Near-duplicates: every pair at the threshold is linked."""

import random

import pytest

from fieldloom.llm import graph, lines, simhash


@pytest.mark.parametrize("group", [64, 3])
def test_similar_sets_connect_all_pairs_that_meet_the_threshold(spark, monkeypatch, group):
    monkeypatch.setattr(lines, "GROUP", group)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for size in (8, 30, 94, 204, 600):
        for _ in range(6):
            words = rng.choices(vocabulary, k=size)
            rows.append(words)
            for _ in range(5):  # copies that lose up to a tenth of the shingles, so that many are at 0.8 or close to it
                cut = rng.randint(0, max(1, size // 50))
                other = list(words)
                for _ in range(cut):
                    other[rng.randrange(size)] = "x" + str(rng.random())
                rows.append(other[rng.randint(0, size // 12) :])
    stem = rng.choices(vocabulary, k=45)  # keys that many sets have; some of them similar, others not
    rows += [stem + rng.choices(vocabulary, k=rng.randint(3, 30)) for _ in range(60)]
    shingles = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in rows]
    pairs = [(i, j) for j in range(len(rows)) for i in range(j) if 5 * len(shingles[i] & shingles[j]) >= 4 * len(shingles[i] | shingles[j])]
    assert sum(5 * len(shingles[i] & shingles[j]) < 4.2 * len(shingles[i] | shingles[j]) for i, j in pairs) > 20
    docs = spark.createDataFrame([(i, " ".join(w), 0) for i, w in enumerate(rows)], "doc_id long, text string, tag long").repartition(4)
    sets, links = simhash.similar_sets(docs)
    node = {r["doc_id"]: r["node"] for r in sets.collect()}
    root = {r["node"]: r["root"] for r in graph.components(links).collect()}
    found = {d: root.get(n, n) for d, n in node.items()}
    parent = list(range(len(rows)))
    for _ in rows:
        before = list(parent)
        for i, j in pairs:
            parent[i] = parent[j] = min(parent[i], parent[j])
        if parent == before:
            break
    least = {}
    for d in range(len(rows)):
        least.setdefault(found[d], d)
    assert [least[found[d]] for d in range(len(rows))] == parent
