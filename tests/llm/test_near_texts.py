"""The similarity stage: five-word sets at 0.8, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import documents, frame, tidy, words

from opsgrain.llm import near_texts
from opsgrain.llm.lsh_forest import shingles


def brute_sets(text, width=5):
    found = (text or "").encode().lower().split()
    return frozenset(tuple(found[i:i + width]) for i in range(max(1, len(found) - width + 1))) if found else frozenset()


def brute_groups(docs, percent=80):
    """The number of its group for every document, by all pairs of distinct sets."""
    sets = [brute_sets(d[1]) for d in docs]
    distinct = list(dict.fromkeys(sets))
    root = {s: i for i, s in enumerate(distinct)}
    holders = {}
    for i, s in enumerate(distinct):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(distinct):
        for j, both in Counter(j for g in s for j in holders[g] if j < i).items():
            if 100 * both >= percent * len(s | distinct[j]):
                p, q = root[s], root[distinct[j]]
                root = {x: q if r == p else r for x, r in root.items()}
    return [root[s] for s in sets]


def brute_one(docs, percent=80):
    def order(d):
        return d[0] is None, d[0] or 0, hashlib.md5((("-" if d[0] is None else str(d[0])) + "\x01" + (d[1] or "")).encode()).digest()

    best = {}
    for g, d in zip(brute_groups(docs, percent), docs):
        if g not in best or order(d) < order(best[g]):
            best[g] = d
    return list(best.values())


def copies(n=150, length=120, seed=3):
    """Texts, copies of them with more and more changed words, and a passage that many of them share."""
    rng = random.Random(seed)
    passage = words(rng, 150, 10_000)
    rows = []
    for i in range(n):
        own = words(rng, length, 10_000) + (passage if i % 3 else [])
        for j in range(4):
            rows.append((10 * i + j, " ".join(own), "en", f"s{i % 9}", 0, "x", 1, "y", 2, b"z", "w", 3, 4))
            for _ in range(1 + i % 3):
                own = list(own)
                own[rng.randrange(len(own))] = f"new{rng.randrange(10 ** 9)}"
    return rows


@pytest.mark.parametrize("percent", [80, 95])
def test_keep_one(spark, percent):
    docs = documents()
    kept = near_texts.keep_one(frame(spark), percent=percent)
    assert kept.columns == frame(spark).columns
    assert tidy(kept.collect()) == tidy(brute_one(docs, percent))


def test_empty(spark):
    assert near_texts.keep_one(frame(spark, [])).collect() == []
    blank = [(i, t, None, None, None, *documents()[0][5:]) for i, t in ((3, ""), (1, None), (None, " \n"))]
    assert [r.doc_id for r in near_texts.keep_one(frame(spark, blank)).collect()] == [1]


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "One  two"), ("c", "three")], "doc_id string, text string")
    assert sorted(r.doc_id for r in near_texts.keep_one(docs).collect()) == ["a", "c"]


def test_near_copies(spark):
    rows = copies()
    assert tidy(near_texts.keep_one(frame(spark, rows)).collect()) == tidy(brute_one(rows))


def test_crowded_anchors(spark):
    """Grids of a crowded anchor: with cells of two sets, at least nine of ten linked pairs still meet in a cell."""
    rows = copies()
    prints = [shingles(r[1].encode(), 5) for r in rows]
    nodes = [(i, near_texts.fingerprint(s), near_texts.anchors(s)) for i, s in enumerate(prints)]
    members = near_texts.cells(spark.createDataFrame(nodes, "node long, fp binary, anchors array<long>"), cell=2).collect()
    held = {}
    for m in members:
        held.setdefault(m.group, set()).add(m.node)
    together = {(a, b) for g in held.values() for a in g for b in g if a < b}
    near = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if rows[a][0] // 10 == rows[b][0] // 10
            and 100 * len(brute_sets(rows[a][1]) & brute_sets(rows[b][1])) >= 80 * len(brute_sets(rows[a][1]) | brute_sets(rows[b][1]))]
    assert len(near) > 200 and sum(p in together for p in near) >= 0.9 * len(near)
    assert max(map(len, held.values())) < 200  # the 400 texts with the passage are parted


def test_distances():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, (40, 4), dtype=np.uint64)
    b = np.concatenate([a ^ (np.uint64(1) << np.uint64(7)), a[:10] ^ rng.integers(0, 1 << 20, (10, 4), dtype=np.uint64)])
    want = [(i, j) for i in range(40) for j in range(50) if sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(a[i], b[j])) <= 30]
    assert sorted(zip(*map(list, near_texts.close(a, b, 30)))) == want
    p, q = near_texts.bit_counts(a[:, 0]), near_texts.bit_counts(b[:40, 0])
    count = lambda x: [bin(int(x) >> s & 3).count("1") for s in range(0, 64, 2)]
    assert near_texts.manhattan(p, q).tolist() == [sum(abs(m - n) for m, n in zip(count(x), count(y))) for x, y in zip(a[:, 0], b[:40, 0])]
