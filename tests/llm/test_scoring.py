"""Language model, byte-level BPE."""

import hashlib
import math
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from cases import documents, frame, tidy

from opsgrain.llm import byte_bpe, hidden_markov

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def tokens(text):
    return (text or "").encode().lower().split() + [hidden_markov.END]


def is_held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def test_base_scores(spark):
    docs = documents()
    counts = Counter()
    for d in docs:
        if not is_held(d[0]):
            counts.update(tokens(d[1]))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for d in docs:
        t = tokens(d[1])
        want.append((d[0], is_held(d[0]), len(t), sum(w in counts for w in t), total,
                     f"{sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t):.8g}"))
    got = hidden_markov.score(frame(spark), rounds=1, states=3).collect()
    assert tidy((*r[:5], f"{r.base_score:.8g}") for r in got) == tidy(want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_bounded_dictionary_changes_nothing(spark, monkeypatch):
    """Words beyond the workers' dictionary are joined; their part of the scores is the same."""
    some = [d for d in documents() if d[1] is None or len(d[1]) < 5000]
    before = {tuple(r[:5]): r.base_score for r in hidden_markov.score(frame(spark, some), rounds=0).collect()}
    monkeypatch.setattr(hidden_markov, "KNOWN", 40)
    monkeypatch.setattr(hidden_markov, "OWN", 10)
    after = hidden_markov.score(frame(spark, some), rounds=1).collect()
    assert {tuple(r[:5]) for r in after} == set(before)
    assert all(math.isclose(r.base_score, before[tuple(r[:5])], rel_tol=1e-9) for r in after)


def test_rare_end(spark, monkeypatch):
    """With fewer texts than the frequent words have occurrences the end's count is right, too."""
    monkeypatch.setattr(hidden_markov, "KNOWN", 3)
    text = "a a a a a b b b b c c c d"
    some = [(i, text, None, None, 0, "x", 1, "y", 2, b"z", "w", 3, 4) for i in range(3) if not is_held(i)]
    n, counts = len(some), {"a": 5, "b": 4, "c": 3, "d": 1}
    want = sum(c * math.log10((c * n + 1) / (14 * n + 6)) for c in counts.values()) + math.log10((n + 1) / (14 * n + 6))
    assert all(math.isclose(r.base_score, want) and r.n_known == 14 for r in hidden_markov.score(frame(spark, some), rounds=1).collect())


def test_forward_is_exact():
    rng = np.random.default_rng(1)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(6), 3).T
    seqs = [rng.integers(0, 6, n).astype(np.uint16) for n in (5, 1, 3, 5, 4)]

    def every_path(s):
        total = 0.0
        for code in range(3 ** len(s)):
            path = [code // 3 ** i % 3 for i in range(len(s))]
            p = start[path[0]] * emit[s[0], path[0]]
            for a, b, x in zip(path, path[1:], s[1:]):
                p *= move[a, b] * emit[x, b]
            total += p
        return math.log(total)

    assert np.allclose(hidden_markov.forward(hidden_markov.Lanes(seqs), start, move, emit), [every_path(s) for s in seqs])


def test_baum_welch_counts_and_progress():
    rng = np.random.default_rng(2)
    start, move, emit = rng.dirichlet(np.ones(2)), rng.dirichlet(np.ones(2), 2), rng.dirichlet(np.ones(4), 2).T
    seqs = [rng.integers(0, 4, n).astype(np.uint16) for n in (4, 2, 3, 1)]
    starts, moves, emitted = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for s in seqs:
        joint = {}
        for code in range(2 ** len(s)):
            path = [code >> i & 1 for i in range(len(s))]
            p = start[path[0]] * emit[s[0], path[0]]
            for a, b, x in zip(path, path[1:], s[1:]):
                p *= move[a, b] * emit[x, b]
            joint[tuple(path)] = p
        whole = sum(joint.values())
        for path, p in joint.items():
            starts[path[0]] += p / whole
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / whole
            for x, a in zip(s, path):
                emitted[x, a] += p / whole
    lanes = hidden_markov.Lanes(seqs)
    for got, want in zip(hidden_markov.expected(lanes, start, move, emit), (starts, moves, emitted)):
        assert np.allclose(got, want)
    old = hidden_markov.forward(lanes, start, move, emit).sum()
    new = hidden_markov.forward(lanes, starts / starts.sum(), moves / moves.sum(1, keepdims=True), emitted / emitted.sum(0)).sum()
    assert new >= old


def test_model_is_a_distribution_over_words(spark):
    """Class probabilities and probabilities within classes add up to one over all words, one unseen word per class included."""
    from opsgrain.session import stage_table

    texts = frame(spark).selectExpr("cast(coalesce(text, '') as binary) as t")
    counts = stage_table(hidden_markov.word_counts(texts))
    held = hidden_markov.tables(counts)
    assert math.isclose(held.unigram.sum(), 1)
    inside = Counter()
    for w, c in counts.collect():
        i = held.words.get(bytes(w))
        k = held.class_of[i] if i is not None else held.own + hidden_markov.shared_class(bytes(w))
        inside[int(k)] += 1.0 if k < held.own else (c + 1) / 10 ** held.log_size[k]
    for k in range(held.own, held.classes):
        inside[k] += 1 / 10 ** held.log_size[k]
    assert all(math.isclose(v, 1) for v in inside.values())


def test_learns_held_out_text(spark):
    """Two made-up languages: states beat the unigram model on texts that were held out."""
    import random
    rng = random.Random(3)
    rows = []
    for i in range(400):
        pool = [f"{'xy'[i % 2]}{k}" for k in range(80)]
        rows.append((i, " ".join(rng.choice(pool) for _ in range(60)), None, None, 0, *("x", 1, "y", 2, b"z", "w", 3, 4)))
    got = [r for r in hidden_markov.score(frame(spark, rows)).collect() if r.held_out]
    assert got and sum(r.score for r in got) > sum(r.base_score for r in got) + 10 * len(got)


def test_no_training_texts(spark):
    held = next(i for i in range(100) if is_held(i))
    some = [(held, "a b", *d[2:]) for d in documents()[:1]]
    row, = hidden_markov.score(frame(spark, some)).collect()
    assert (row.train_tokens, row.n_known, row.n_tokens, row.base_score) == (0, 0, 3, 0.0)
    assert hidden_markov.score(frame(spark, [])).collect() == []


@pytest.fixture(scope="module")
def library():
    words = byte_bpe.Vocabulary(PATH, PATTERN)
    return words, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in words.tokens.items()}, special_tokens={})


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 1 << 10), (64, 24), (16, 4)])
def test_bpe_like_the_library(spark, library, chunk, overlap):
    docs = [d for d in documents() if chunk > 1000 or len(d[1] or "") < 20_000]
    got = byte_bpe.digest(frame(spark, docs), PATH, PATTERN, chunk=chunk, overlap=overlap).collect()
    want = []
    for d in docs:
        i = library[1].encode_ordinary(d[1] or "")
        want.append((d[0], len(i), hashlib.sha256(struct.pack(f"<{len(i)}I", *i)).hexdigest(), hashlib.sha256((d[1] or "").encode()).hexdigest()))
    assert tidy(got) == tidy(want)


def test_bpe_engines_agree(library):
    """Both pre-tokenisers, on every character for which the faster one is used and some others."""
    words, enc = library
    for cp in [*range(0x500), *range(0x2000, 0x2100), 0x3000, 0x4E00, 0xFF11]:
        c = chr(cp)
        text = f"a{c}b1{c}{c}2 {c}'{c}  {c}\n\n{c}_{c} '{c}s"
        pieces = words.cuts(text).findall(text)
        assert pieces == words.pattern.findall(text), hex(cp)
        assert list(struct.unpack(f"<{len(words.encode(text)) // 4}I", words.encode(text))) == enc.encode_ordinary(text)


def test_bpe_decode(spark):
    ids = byte_bpe.encode(frame(spark), PATH, PATTERN)
    back = byte_bpe.decode(ids, PATH, PATTERN).collect()
    assert tidy((r.doc_id, bytes(r.data).decode()) for r in back) == tidy((d[0], d[1] or "") for d in documents())


def test_bpe_empty(spark):
    assert byte_bpe.encode(frame(spark, []), PATH, PATTERN).collect() == []
