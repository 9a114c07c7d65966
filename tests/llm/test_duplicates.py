"""Line dedup, substring dedup, SimHash, decontamination against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from cases import documents, frame, tidy

from opsgrain.llm import components, decontaminate, line_dedup, simhash, substrings
from opsgrain.session import stage_table


def lines_of(text):
    return [(raw, raw.strip(" \t\n\r\x0b\x0c")) for raw in (text or "").split("\n")]


def brute_lines(docs, min_sites, share=1.0):
    sites = defaultdict(set)
    for d in docs:
        for _, bare in lines_of(d[1]):
            if bare and d[3] is not None:
                sites[bare].add(d[3])
    wide = {b for b, s in sites.items() if len(s) >= min_sites}
    out = []
    for d in docs:
        lines = lines_of(d[1])
        bad = sum(b in wide for _, b in lines)
        cut = bad and sum(len(b) for _, b in lines if b in wide) <= share * sum(len(b) for _, b in lines)
        kept = "\n".join(raw for raw, b in lines if not (cut and b in wide))
        out.append((d[0], None if d[1] is None else kept, sum(b != "" for _, b in lines), bad, bad if cut else 0))
    return out


@pytest.mark.parametrize("min_sites, share", [(1, 1.0), (2, 1.0), (10, 1.0), (14, 1.0), (15, 1.0), (2, 0.5), (10, 0.5)])
def test_lines(spark, min_sites, share):
    docs = documents()
    got = line_dedup.strip_lines(frame(spark), min_sites=min_sites, max_share=share)
    assert got.columns == [*frame(spark).columns, "n_lines", "n_widespread", "n_removed"]
    assert tidy(got.select("doc_id", "text", "n_lines", "n_widespread", "n_removed").collect()) == tidy(brute_lines(docs, min_sites, share))
    if share == 1.0:
        assert got.where("n_removed <> n_widespread").count() == 0


def test_line_band_is_counted_exactly(spark):
    """400 sites are beyond the sketch's exact range; the counts near the threshold are right all the same."""
    rows = [(i, f"line a\nline {i}\n" + ("line b" if i else ""), "en", f"site {i}", 0, "x", 1, "y", 2, b"z", "w", 3, 4) for i in range(400)]
    found = {bytes(r.line): r.sites for r in line_dedup.widespread(frame(spark, rows), min_sites=400).collect()}
    assert found == {hashlib.md5(b"line a").digest(): 400}


def test_pages_of_boilerplate(spark):
    """Widespread lines go however much of a document they are; only copies on several sites stay whole."""
    more = (0, "x", 1, "y", 2, b"z", "w", 3, 4)
    nav, foot = " ".join(f"nav{i}" for i in range(30)), " ".join(f"foot{i}" for i in range(30))
    story = "\n".join(" ".join(f"story{i}x{j}" for j in range(20)) for i in range(5))
    rows = [(i, f"{nav}\n" + " ".join(f"own{i}w{j}" for j in range(25)) + f"\n{foot}", "en", f"s{i}", *more) for i in range(12)]
    rows += [(100 + i, story, "en", f"s{i}", *more) for i in range(12)] + [(100, story, "en", "s0", *more)]
    rows += [(200, f"{foot}\n\n{nav}", "en", "s1", *more), (201, f"{foot}\n\n{nav}", "en", "s1", *more), (202, None, None, None, *more)]
    want = [(d[0], d[1] if d[0] in (*range(100, 112), 202) else "" if d[0] in (200, 201) else d[1].split("\n")[1]) for d in rows]
    got = line_dedup.strip_pages(frame(spark, rows))
    assert got.columns == frame(spark, rows).columns
    assert tidy(got.select("doc_id", "text").collect()) == tidy(want)
    assert line_dedup.strip_pages(frame(spark, [])).collect() == []


def test_lines_empty(spark):
    assert line_dedup.strip_lines(frame(spark, [])).collect() == []


def brute_windows(docs, length):
    texts = [(d[1] or "").encode().split() for d in docs]
    seen = Counter(tuple(w[i:i + length]) for w in texts for i in range(len(w) - length + 1))
    out = []
    for d, w in zip(docs, texts):
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((d[0], len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("length, gathered", [(35, 10_000), (35, 3), (5, 10_000), (1, 100)])
def test_substrings(spark, length, gathered):
    docs = [d for d in documents() if length > 5 or len(d[1] or "") < 20_000]
    got = substrings.remove_repeats(frame(spark, docs), length=length, gathered=gathered).collect()
    assert tidy(got) == tidy(brute_windows(docs, length))


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(substrings, "PART", 50)
    words = [b"%d" % (i % 23) for i in range(400)]
    where = [range(a, b) for _, first, end, _ in substrings.runs(words, 10) for a, b in zip(first.tolist(), end.tolist())]
    assert [i for r in where for i in r] == list(range(391))


def test_automaton_shards():
    runs = Counter({b"a b a b a b a": 1, b"b a b c": 2, b"c c c c": 1, b"b c": 1})
    for shard in (1, 2, 500):
        for length in (1, 2, 3):
            seen = Counter()
            for run, n in runs.items():
                w = run.split()
                for i in range(len(w) - length + 1):
                    seen[tuple(w[i:i + length])] += n
            want = {r: [i for i in range(len(r.split()) - length + 1) if seen[tuple(r.split()[i:i + length])] > 1]
                    for r in runs if len(r.split()) >= length}
            some = Counter({r: n for r, n in runs.items() if r in want})
            seen_by = substrings.repeated(some, length, shard)
            if length < 3:
                assert seen_by == want


def test_substrings_empty(spark):
    assert substrings.remove_repeats(frame(spark, [])).collect() == []


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(docs, distance=4):
    prints = [brute_print(d[1]) for d in docs]
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    distinct = sorted(parent)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    least = {}
    for d, p in zip(docs, prints):
        if d[0] is not None:
            least[find(p)] = min(d[0], least.get(find(p), d[0]))
    return [(d[0], f"{p:016x}", least.get(find(p))) for d, p in zip(docs, prints)]


@pytest.mark.parametrize("distance, bands", [(4, 7), (4, 5), (4, 8), (0, 3), (12, 14)])
def test_simhash(spark, distance, bands):
    docs = documents()
    got = simhash.near_duplicates(frame(spark), distance=distance, bands=bands).selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0'))", "component_id")
    assert tidy(got.collect()) == tidy(brute_components(docs, distance))


def test_links_are_all_found(spark):
    import random
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    near = {b for b in base} | {b ^ sum(1 << i for i in rng.sample(range(64), k)) for b in base for k in (1, 2, 3, 4, 5, 6) for _ in range(6)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in near]
    got = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    want = {(a, b) for a, in signed for b, in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_cells_are_not_broadcast(spark):
    """By the bytes of a small table of nodes Spark would send all its cells, many times as much, to the driver."""
    nodes = stage_table(spark.createDataFrame([(v,) for v in (0, 1, 7, 255, 256, -1, -2)], "fp long"))
    found = simhash.links(nodes)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {tuple(r) for r in found.collect()} == {(0, 1), (0, 7), (0, 256), (1, 7), (1, 256), (7, 256), (-2, -1)}
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (150, 200)] + [(300, 300 + i) for i in range(1, 30)]
    got = {r.node: r.root for r in components.roots(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 150: 100, 200: 100, **{300 + i: 300 for i in range(30)}}


def test_keep_one(spark):
    docs = documents()
    want = []
    done = set()
    for (i, p, c), d in sorted(zip(brute_components(docs), docs), key=lambda x: (x[1][0] is None, x[1][0] or 0, hashlib.md5(
            (("-" if x[1][0] is None else str(x[1][0])) + "\x01" + (x[1][1] or "")).encode()).digest())):
        name = c if c is not None else f"none {p}"
        if name not in done:
            done.add(name)
            want.append(d)
    kept = simhash.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    assert [(r.doc_id, r.text or "") for r in sorted(kept.collect(), key=repr)] == [(d[0], d[1] or "") for d in sorted(kept.sparkSession.createDataFrame(want, kept.schema).collect(), key=repr)]
    assert simhash.keep_one(frame(spark, [])).collect() == []


def brute_holders(docs, items, percent=80):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w, k: {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    out = set()
    for item_id, text in set(items):
        w = split(text)
        if not w:
            continue
        mine = grams(w, min(5, len(w)))
        for d in docs:
            shared = len(mine & grams(split(d[1]), min(5, len(w))))
            if shared * 100 >= len(mine) * percent:
                out.add((d[0], d[1] or "", item_id, len(mine), shared))
    return out


def items():
    docs = documents()
    long = docs[0][1].split()
    chosen = [(i, " ".join(d[1].upper().split()[3:40])) for i, d in enumerate(docs[:20]) if len(d[1].split()) > 45]
    passage = docs[4][1].split()[10:60]
    return chosen + [(100, " ".join(passage[:25] + ["other"] + passage[25:])), (101, None), (102, ""), (103, "a, B! c"), (None, "w1 w2"), (104, "x"),
                     (100, "a second text of item one hundred"), (105, "...")] + [(106, "a, B! c")] * 2 + [(107, " ".join(long[:30][::-1]))]


def test_containment(spark):
    docs, bench = documents(), items()
    got = decontaminate.held_items(frame(spark), spark.createDataFrame(bench, "item_id long, text string"))
    assert tidy((a, c, d, e) for a, _, c, d, e in brute_holders(docs, bench)) == tidy(got.select("doc_id", "item_id", "n_shingles", "n_shared").collect())


def test_drop_holders(spark):
    docs, bench = documents(), items()
    gone = {r[:2] for r in brute_holders(docs, bench)}
    table = spark.createDataFrame(bench, "item_id long, text string")
    kept = decontaminate.drop_holders(frame(spark), table)
    assert kept.columns == frame(spark).columns
    assert tidy(kept.select("doc_id", "text").collect()) == tidy(d[:2] for d in docs if (d[0], d[1] or "") not in gone)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_holders(frame(spark), empty).count() == len(docs)
    assert decontaminate.held_items(frame(spark, []), table).collect() == []
