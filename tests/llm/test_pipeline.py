"""The whole pipeline against a brute-force version, stage after stage."""

import hashlib
import struct
from collections import Counter

import corpus_pipeline
import pytest
from cases import SCHEMA, documents, frame, tidy
from test_duplicates import brute_holders, brute_lines, items
from test_near_texts import brute_one
from test_rules import slow_measure
from test_scoring import PATH, PATTERN

from opsgrain.llm import byte_bpe, quality


def brute_quality(docs, labels):
    measured = [dict(zip(quality.MEASURES, slow_measure(d[1] or ""))) for d in docs]
    failed = [m["n_words"] < 50 or 2 * m["n_repeat_words"] > m["n_words"] for m in measured]
    marks = {}
    for i, good, _ in labels:
        if i is not None and good is not None:
            marks[i] = min(good, marks.get(i, 1))
    strata = {d[2] or "" for d, f in zip(docs, failed) if not f and d[0] in marks}
    kept = [not f for f in failed]
    for rule, (up, down, scale) in quality.RULES.items():
        value = [min(1000, scale * m[up] // m[down]) if m[down] else 0 for m in measured]
        for stratum in strata:
            seen = {}
            for d, v, f in zip(docs, value, failed):
                if not f and d[0] in marks and (d[2] or "") == stratum:
                    seen.setdefault(v, Counter())[marks[d[0]] > 0] += 1
            cut = quality.choose([(v, c[True], c[False]) for v, c in seen.items()], quality.RISK / len(quality.RULES),
                                 quality.DELTA / len(quality.RULES) / len(strata))
            for i, d in enumerate(docs):
                if cut is not None and (d[2] or "") == stratum and value[i] > cut:
                    kept[i] = False
    return [d for d, k in zip(docs, kept) if k]


@pytest.fixture(scope="module")
def tables():
    docs = [d for d in documents(n=90) if len(d[1] or "") < 10_000]
    for i in range(2600):  # enough labels for a bound, every tenth document full of symbols
        bad = i % 10 == 0
        text = " ".join(f"w{(i * 31 + j * j * 7 + i * j) % 4999}" + ("##" if bad else "") for j in range(64))
        docs.append((10_000 + i, text + ("\nAll rights  reserved é" if i % 50 == 1 else ""), "en", f"s{i % 14}", len(text), *docs[0][5:]))
    labels = [(10_000 + i, int(i % 10 != 0), 0) for i in range(2600)] + [(None, 1, 0), (3, None, 0)]
    bench = items() + [(200, docs[-3][1]), (201, docs[-7][1])]
    return docs, labels, bench


def test_against_brute_force(spark, tables, tmp_path):
    docs, labels, bench = tables
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want, step = docs, spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = step.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == names
        before = len(want)
        if name == "quality rules":
            want = brute_quality(want, labels)
        elif name == "line dedup":
            want = [(d[0], text, d[2], d[3], None if text is None else len(text), *d[5:]) for d, (_, text, *_) in zip(want, brute_lines(want, 10))]
        elif name == "simhash near-dedup":
            want = brute_one(want)
        else:
            gone = {r[:2] for r in brute_holders(want, bench)}
            want = [d for d in want if (d[0], d[1] or "") not in gone]
        assert tidy(step.select("doc_id", "text", "lang", "source", "n_chars").collect()) == tidy(d[:5] for d in want), name
        assert name == "line dedup" or len(want) < before, name
        step = spark.createDataFrame(step.collect(), SCHEMA)
    words = byte_bpe.Vocabulary(PATH, PATTERN)
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in words.tokens.items()}, special_tokens={})
    end = []
    for d in want:
        ids = enc.encode_ordinary(d[1] or "")
        end.append((d[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((d[1] or "").encode()).hexdigest()))
    assert tidy(corpus_pipeline.run(spark, str(tmp_path)).collect()) == tidy(end)


def test_empty_tables(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
