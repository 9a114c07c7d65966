"""Hard negatives, filter audit and LSH forest against brute force."""

import math
import random
from collections import Counter, defaultdict
from itertools import combinations, permutations

import numpy as np
import pytest
from cases import documents, frame, tidy

from pyspark.sql import functions as F

from opsgrain.llm import filter_audit, hard_negatives, lsh_forest

MORE = ("x", 1, "y", 2, b"z", "w", 3, 4)

# --- hard negatives ---

NAN, INF = math.nan, math.inf
VECTORS = "vec_id long, label int, embedding array<double>, id int, row int, cell string, anchor string, v string, score int, no int"
CLASH = (1, 2, "c", "a", "v", 3, 4)


def brute_negatives(rows, every):
    rows = list({(i, lab, tuple(math.floor(256 * x) for x in v)) for i, lab, v in rows
                 if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for a in rows:
        if a[0] is None or a[0] % every:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(a[2], b[2])), b[0] is None, b[0] or 0, b) for b in rows if b != a), key=lambda s: s[:3])
        for p, _, _, pos in [s for s in scored if s[3][1] == a[1]][:5]:
            fit = [(n, neg) for n, _, _, neg in scored if neg[1] != a[1] and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out += [(a[0], pos[0], k + 1, neg[0], -p, -n) for k, (n, neg) in enumerate(fit)]
    return out


def vectors(seed, n=700, dims=24, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    made = []
    for i in range(n):
        v = rng.normal(size=dims) + (centres[i % 6] * rng.integers(0, 4) if i % 3 else 0)
        made.append((i, int(rng.integers(labels)) if i % 4 else i % 6, [float(x) for x in v / np.linalg.norm(v) * (1 if i % 9 else 3)]))
    one = made[0][2]
    made += [(1000 + i, i % labels, list(one)) for i in range(150)]  # ties
    made += [made[10]] * 4  # repeated rows
    made += [(2000, None, one), (2050, 1, None), (2100, 1, [None] * dims), (2150, 1, [NAN] * dims), (2200, 2, [INF] + one[1:]), (None, 1, one), (None, 0, one),
             (2250, 1, []), (2300, 1, [0.0] * dims), (2350, 2, one[:7]), (2400, 77, one), (2450, 78, [-x for x in one])]
    return made


def vector_frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, lab, v, *CLASH) for i, lab, v in rows], VECTORS).repartition(parts)


@pytest.mark.parametrize("seed, cell, tile", [(1, 1 << 15, (256, 4096)), (2, 200, (16, 50)), (3, 90, (256, 64))])
def test_negatives(spark, monkeypatch, seed, cell, tile):
    monkeypatch.setattr(hard_negatives, "CELL", cell)
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    rows = vectors(seed)
    got = hard_negatives.mine(vector_frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert tidy(got.collect()) == tidy(brute_negatives(rows, 10))


def test_negatives_long_vectors_and_empty(spark):

    rng = random.Random(5)
    rows = [(i, i % 3, [rng.uniform(-1, 1) * 2e5 for _ in range(5)]) for i in range(60)]  # squared norms beyond 2**52
    got = hard_negatives.mine(vector_frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert tidy(got.collect()) == tidy(brute_negatives(rows, 10))
    assert hard_negatives.mine(vector_frame(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives.mine(vector_frame(spark, [(1, 1, [1.0]), (3, 2, [1.0])]), F.col("vec_id") % 10 == 0).collect() == []
    named = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("b", 1, [0.9, 0.1]), ("c", 2, [0.6, 0.0]), ("d", 2, [0.8, 0.1])], "vec_id string, label int, embedding array<float>")
    assert [r[:4] for r in hard_negatives.mine(named, F.col("vec_id") == "a").orderBy("rank").collect()] == [("a", "b", 1, "d"), ("a", "b", 2, "c")]


@pytest.mark.parametrize("level", [0.0, 0.1, 0.4, 0.8, 5.0])
def test_index_finds_every_pair_and_omits_dimensions(level):
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.normal(size=(400, 40)) * np.linspace(2, 0.05, 40) / 6)
    a = x[:60]
    norm = np.linalg.norm(a, axis=1)
    top = level * norm.max()
    least = np.ceil(top * norm).astype(np.int64)
    index = hard_negatives.Index(x, top)
    found = {(i, j): s for part in index.join(a, least) for i, j, s in zip(*map(np.ndarray.tolist, part))}
    exact = (a @ x.T).astype(np.int64)
    assert found == {(i, j): exact[i, j] for i, j in zip(*map(np.ndarray.tolist, np.nonzero(exact >= least[:, None])))}
    assert level == 0 or (index.indexed != index.full).any()


# --- filter audit ---

LABELS = "doc_id long, quality int, toxic int, part string, key int, `a.b` int"


def fails(docs):
    first = {}
    for d in docs:
        if d[0] is not None:
            first[d[1] or ""] = min(first.get(d[1] or "", d[0]), d[0])
    for d in docs:
        text = d[1] or ""
        words = text.encode().split()
        bad = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
               "D": any(c in "#$%&*|" for c in text), "E": d[0] is not None and first[text] < d[0]}
        yield {k for k, v in bad.items() if v}


def brute_audit(docs, labels):
    good, toxic = ({r[0] for r in labels if r[0] is not None and r[k] == 1} for k in (1, 2))
    cases = Counter((d[2] or "", frozenset(f), d[0] in good, d[0] in toxic) for d, f in zip(docs, fails(docs)))
    out = []
    for part in {c[0] for c in cases}:
        mine = [(f, g, t, n) for (p, f, g, t), n in cases.items() if p == part]
        rows = []
        for order in permutations("ABCDE"):
            for k, x in enumerate(order):
                before = set(order[:k])
                gone = [c for c in mine if x in c[0] and not before & c[0]]
                rows.append((part, "".join(order), k + 1, sum(c[3] for c in mine if not (before | {x}) & c[0]), sum(c[3] for c in gone),
                             sum(c[3] for c in mine if x in c[0] and before & c[0]), sum(c[3] for c in mine if c[0] == {x}),
                             sum(c[3] for c in gone if c[1]), sum(c[3] for c in gone if c[2])))
        total = Counter()
        for r in rows:
            total[r[1][r[2] - 1]] += r[4]
        out += [(*r, total[r[1][r[2] - 1]]) for r in rows]
    return out


def test_audit(spark):
    docs = [(d[0], d[1], d[2], *d[3:]) for d in documents()]
    docs += [(6000 + i, f"{'Price 5 $ ' * (i % 3)}" + " ".join(f"w{i}x{k}" for k in range(40 * (i % 5))), ("en", "it", None, "")[i % 4], "s", 1, *MORE) for i in range(80)]
    docs += [(7000 + i, docs[-1][1], "en", "s", 1, *MORE) for i in range(40)] + [(None, docs[-1][1], "en", "s", 1, *MORE)] * 3
    rng = random.Random(1)
    labels = [(d[0], rng.choice([0, 1, None]), rng.choice([0, 1, None]), "p", 1, 2) for d in docs[::2]] + [(docs[4][0], 1, 1, "p", 1, 2), (docs[4][0], 0, 0, "p", 1, 2), (None, 1, 1, None, None, None)]
    got = filter_audit.audit(frame(spark, docs), spark.createDataFrame(labels, LABELS))
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert tidy(got.select(columns).collect()) == tidy(brute_audit(docs, labels))
    assert got.where("substr(filter_order, step, 1) <> filter").isEmpty()


def test_audit_empty(spark):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(frame(spark, []), none).collect() == []
    assert filter_audit.audit(frame(spark, documents()[:9]), none).where("good_lost + toxic_lost > 0").isEmpty()


# --- LSH forest ---


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 3]) for i in range(len(words) - 2)) or frozenset([tuple(words)] if words else [])


def brute_forest(docs, percent=85):
    sets = [shingle_set(d[1]) for d in docs]
    unique = list({s for s in sets if s})
    root = {s: s for s in unique}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    by = defaultdict(list)
    for k, s in enumerate(unique):
        for x in s:
            by[x].append(k)
    shared = Counter(p for ks in by.values() for p in combinations(ks, 2))
    for (i, j), n in shared.items():
        if 100 * n >= percent * (len(unique[i]) + len(unique[j]) - n):
            root[find(unique[i])] = find(unique[j])
    least = defaultdict(list)
    for d, s in zip(docs, sets):
        if s and d[0] is not None:
            least[find(s)].append(d[0])
    out = []
    for d, s in zip(docs, sets):
        component = min(least[find(s)], default=None) if s else d[0]
        out.append((d[0], len(s), component, d[0] == component))
    return out


def templates(n=160):
    """A dense family of near copies: edits of all sizes, so that links chain and break near the threshold."""
    rng = random.Random(9)
    base = [f"t{i}" for i in range(90)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(0, 7)):
            words[rng.randrange(90)] = f"e{rng.randrange(30)}"
        out.append((9000 + i, " ".join(words), "en", "s", 1, *MORE))
    return out


@pytest.mark.parametrize("region, block", [(1024, 512), (20, 16)])
def test_forest(spark, monkeypatch, region, block):
    monkeypatch.setattr(lsh_forest, "REGION", region)
    monkeypatch.setattr(lsh_forest, "BLOCK", block)
    docs = documents() + templates()
    got = lsh_forest.near_duplicates(frame(spark, docs))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert tidy(got.collect()) == tidy(brute_forest(docs))


def test_forest_empty_and_string_ids(spark):
    assert lsh_forest.near_duplicates(frame(spark, [])).collect() == []
    text = " ".join(f"w{i}" for i in range(60))
    named = spark.createDataFrame([("b", text), ("a", text + " end"), ("c", "other"), (None, "other"), (None, None)], "doc_id string, text string")
    assert tidy(lsh_forest.near_duplicates(named).collect()) == tidy([("b", 58, "a", False), ("a", 59, "a", True), ("c", 1, "c", True), (None, 1, "c", False),
                                                                      (None, 0, None, True)])


def test_exact_overlap():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 40)).astype(np.uint64)) for _ in range(60)]
    got = set(zip(*map(np.ndarray.tolist, lsh_forest.overlapping(sets, sets, 60))))
    want = {(i, j) for i, a in enumerate(map(set, map(np.ndarray.tolist, sets))) for j, b in enumerate(map(set, map(np.ndarray.tolist, sets))) if 100 * len(a & b) >= 60 * len(a | b)}
    assert got == want
