"""Awkward documents that every corpus operator has to take: nulls, empty and long texts, ties, copies, odd columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _key string, words int, m string, h long, t binary, "
          "line string, fp long, `a.b c` int")
EXTRA = ("x", 1, "y", 2, b"z", "w", 3, 4)


def words(rng, n, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def documents(seed=5, n=60):
    rng = random.Random(seed)
    passage = words(rng, 60, 10_000)
    made = []
    for i in range(n):
        own = words(rng, rng.randrange(0, 200))
        if i % 4 == 0:
            at = rng.randrange(len(own) + 1)
            own = own[:at] + passage[rng.randrange(20):] + own[at:]
        breaks = [" ", " ", " ", "\n", "  ", "\t", "\r\n"]
        made.append((i, "".join(w + rng.choice(breaks) for w in own), ("en", "de", None)[i % 3], f"s{i % 14}"))
    common = "All rights  reserved é"
    made += [(1000 + i, f"{common}\nbody {i} " + " ".join(words(rng, 60)) + f"\n {common}\t\nend {i}", "en", f"s{i}") for i in range(14)]
    made += [(None, None, None, None), (None, "", "en", "s1"), (7, None, "fr", "s1"), (2000, "", "en", None), (2001, " \n\t\r\n ", "en", "s2"),
             (2002, "x", "en", "s2"), (2003, "a b c", "en", "s2"), (2004, "A b C", "en", "s2"), (None, "null id text " * 20, None, "s3")]
    long = " ".join(words(rng, 40_000, 50_000))
    made += [(3000, long, "en", "s0"), (3001, long + " tail", "en", "s1"), (3002, "y" * 70_000 + " z", "en", "s0"), (3003, "ab " * 30_000, "en", "s0")]
    same = " ".join(words(rng, 120))
    made += [(4000 + i, same, "en", "s4") for i in range(12)]
    made += [(4000, same, "en", "s4")] * 5  # repeated rows
    near = same.split()
    made += [(4100 + i, " ".join(near[:i] + ["changed"] + near[i + 1:]), "de", "s5") for i in range(0, 120, 7)]
    made += [(5000, "Ünïcode ſtraße İ 。 １２ ² ½   \x1c _a_ 'Re don't'll \U0001f600\U0001f600", "fr", "s6")]
    return [(*d, None if d[1] is None else len(d[1]), *EXTRA) for d in made]


def frame(spark, rows=None, parts=5):
    rows = documents() if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def tidy(rows):
    return sorted((tuple(r) for r in rows), key=repr)
