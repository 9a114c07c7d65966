"""A hidden Markov language model: Baum-Welch counts summed across partitions, exact likelihoods by scaled forward recursion.

Words are observed through classes: each of the most frequent words is a class of its own, the others share classes by
their last bytes. P(word | state) = P(class | state) * P(word | class), the second factor from add-one counts
within the class, so the model is a distribution over all words and its tables per state stay bounded while the
counts grow with the corpus. Counts of words beyond the bounded dictionary are joined by word.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.llm.common import batches_of, col, rows, small_batches, text_or_empty
from opsgrain.session import stage_table

END = b"\n"  # the end of a text; white space can't be a word
STATES = 8
ROUNDS = 5
OWN = 8192  # words that are classes of their own, about
SHARED = 4096  # classes that the other words share
SUFFIX = 3  # bytes at a word's end that choose its shared class
KNOWN = 131_072  # words whose counts every worker holds; their size is bounded by LONGEST
LONGEST = 64
WINDOW = 1024  # training sequences are runs of at most so many tokens; likelihoods always span the whole text
BLOCK = 2_000_000  # tokens that a worker handles at once
SEED = 7
HELD_OUT, FOLDS = 2, 7
FLUSH = 300_000  # distinct words a worker counts before it hands them on


def held_out(doc_id: str) -> Column:
    """Texts the model may not learn from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def shared_class(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX:]) % SHARED


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c): counts of all words of the column ``t`` and of one end per text."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for (text,) in rows(batches):
            seen.update(text.lower().split())
            seen[END] += 1
            if len(seen) >= FLUSH:
                yield from batches_of(seen.items(), schema, size=65536)
                seen.clear()
        yield from batches_of(seen.items(), schema, size=65536)

    return texts.mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _frequent(counts: DataFrame, limit: int) -> int:
    """A count from which on there are at most ``limit`` words; read off at most 1,024 bins."""
    bins = counts.groupBy(F.floor(16 * F.log2("c")).alias("bin")).agg(F.count("*").alias("n"), F.min("c").alias("low")).orderBy(F.desc("bin")).collect()
    total, low = 0, 1 << 62
    for _, n, first in bins:
        total += n
        if total > limit:
            break
        low = first
    return low


class Tables:
    """What every worker holds: the frequent words with class and count, and the classes' sizes. Bounded by KNOWN words."""

    def __init__(self, frequent: list[tuple[bytes, int]], own: int, shared: dict[int, tuple[int, int]], total: int, distinct: int):
        self.total, self.distinct = total, distinct
        self.classes = own + SHARED
        self.words = {w: i for i, (w, _) in enumerate(frequent)}
        self.class_of = np.array([i if i < own else own + shared_class(w) for i, (w, _) in enumerate(frequent)], np.uint16)
        self.log_count = np.log10(np.array([c for _, c in frequent], float) + 1)
        self.own = own
        # mass of every class in training, and the log of a shared class's denominator
        mass = np.zeros(self.classes)
        mass[:own] = [c for _, c in frequent[:own]]
        self.log_size = np.zeros(self.classes)
        for k in range(SHARED):
            n, v = shared.get(k, (0, 0))
            mass[own + k] = n
            self.log_size[own + k] = math.log10(n + v + 1)
        self.unigram = (mass + 1) / (mass.sum() + self.classes)


def tables(counts: DataFrame) -> Tables:
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    short = counts.where(F.octet_length("word") <= LONGEST)
    frequent = [(bytes(w), c) for w, c in short.where(F.col("c") >= _frequent(short, KNOWN)).collect()]  # at most KNOWN words
    if not any(w == END for w, _ in frequent):  # the end has a class of its own, however few texts there are
        ends = counts.where(F.col("word") == F.lit(END)).collect()
        frequent.append((END, ends[0].c if ends else 0))
    frequent.sort(key=lambda wc: (wc[0] != END, -wc[1], wc[0]))
    own = min(OWN, len(frequent))
    # sizes of the shared classes: all words, less those that are alone
    shared: dict[int, list[int]] = {k: [n, v] for k, n, v in counts.groupBy(
        (F.crc32(F.substring("word", -SUFFIX, SUFFIX)) % SHARED).cast("int")).agg(F.sum("c"), F.count("*")).collect()}
    for w, c in frequent[:own]:
        if c:
            cell = shared[shared_class(w)]
            cell[0], cell[1] = cell[0] - c, cell[1] - 1
    return Tables(frequent, own, {k: tuple(v) for k, v in shared.items()}, total, distinct)


def classified(texts: DataFrame, held: Tables) -> DataFrame:
    """Every text as a class sequence, with its sums over frequent words and the list of its other words."""
    shipped = texts.sparkSession.sparkContext.broadcast(held)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("classes", pa.binary()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("log_counts", pa.float64()), ("log_within", pa.float64()), ("rare", pa.list_(pa.binary()))])

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shipped.value
        get, n_words = t.words.get, len(t.words)
        class_of = np.append(t.class_of, 0).astype(np.uint16)
        log_count = np.append(t.log_count, 0.0)
        within = np.where(np.arange(n_words + 1) >= t.own, log_count, 0.0)
        cache: dict[bytes, int] = {}

        def records():
            for doc_id, held_out, text in rows(batches):
                words = text.lower().split()
                words.append(END)
                at = np.array([get(w, n_words) for w in words], np.int64)
                classes = class_of[at]
                missing = np.flatnonzero(at == n_words)
                rare = [words[i] for i in missing.tolist()]
                if rare:
                    codes = []
                    for w in rare:
                        tail = w[-SUFFIX:]
                        code = cache.get(tail)
                        if code is None:
                            if len(cache) > 1_000_000:
                                cache.clear()
                            code = cache[tail] = t.own + shared_class(tail)
                        codes.append(code)
                    classes[missing] = codes
                known = len(words) - len(rare) - (t.total == 0)
                yield (doc_id, held_out, classes.tobytes(), len(words), known, float(log_count[at].sum()),
                       float(within[at].sum() - t.log_size[classes].sum()), rare)

        yield from batches_of(records(), schema, size=512)

    return texts.mapInArrow(mapped, "doc_id long, held_out boolean, classes binary, n_tokens long, n_known long, log_counts double, "
                                    "log_within double, rare array<binary>")


class Lanes:
    """Sequences side by side, longest first: step t handles the first ``active[t]`` of them at once."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        steps = int(lengths[0])
        ended = np.cumsum(np.bincount(lengths, minlength=steps + 1))[:steps]
        self.active = len(sequences) - ended
        self.at = np.concatenate(([0], np.cumsum(self.active)))
        flat = np.concatenate([sequences[i] for i in self.order])
        lane = np.repeat(np.arange(len(sequences)), lengths)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.symbols = np.empty(len(flat), np.uint16)
        self.symbols[self.at[step] + lane] = flat


def forward(lanes: Lanes, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Natural log likelihood of every sequence, in the order they came in."""
    ones = np.ones(len(start))
    out = np.zeros(len(lanes.order))
    a = None
    for t, n in enumerate(lanes.active):
        e = emit[lanes.symbols[lanes.at[t]:lanes.at[t + 1]]]
        a = start * e if a is None else (a[:n] @ move) * e
        scale = a @ ones
        a /= scale[:, None]
        out[:n] += np.log(scale)
    back = np.empty_like(out)
    back[lanes.order] = out
    return back


def expected(lanes: Lanes, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of a block: starts, moves and emissions by class."""
    k = len(start)
    ones, total = np.ones(k, emit.dtype), int(lanes.at[-1])
    alpha, scales = np.empty((total, k), emit.dtype), np.empty(total, emit.dtype)
    a = None
    for t, n in enumerate(lanes.active):
        i, j = lanes.at[t], lanes.at[t + 1]
        e = emit[lanes.symbols[i:j]]
        a = start * e if a is None else (a[:n] @ move) * e
        scale = a @ ones
        a /= scale[:, None]
        alpha[i:j], scales[i:j] = a, scale
    moves = np.zeros((k, k))
    ahead = None
    for t in range(len(lanes.active) - 1, -1, -1):
        i, j = lanes.at[t], lanes.at[t + 1]
        beta = np.ones((j - i, k), emit.dtype)
        if ahead is not None:
            n = len(ahead)
            moves += alpha[i:i + n].T @ ahead
            beta[:n] = ahead @ move.T
        alpha[i:j] *= beta
        ahead = emit[lanes.symbols[i:j]] * beta / scales[i:j, None]
    starts = alpha[:lanes.at[1]].sum(0, dtype=float)
    emitted = np.stack([np.bincount(lanes.symbols, alpha[:, s], len(emit)) for s in range(k)], axis=1)
    return starts, moves * move, emitted


def _blocks(sequences: Iterable[tuple], limit: int) -> Iterator[list[tuple]]:
    """(tag, sequence) pairs in blocks of about ``limit`` tokens."""
    held, weight = [], 0
    for tag, sequence in sequences:
        held.append((tag, sequence))
        weight += len(sequence)
        if weight >= limit:
            yield held
            held, weight = [], 0
    if held:
        yield held


def _round(staged: DataFrame, model: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass of Baum-Welch over all training texts; the sums are a row per class, start and state."""
    start, move, emit = model
    k, classes = len(start), len(emit)
    shipped = staged.sparkSession.sparkContext.broadcast(tuple(x.astype(np.float32) for x in model))
    names = [f"s{i}" for i in range(k)]

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes + 1 + k, k))

        def runs():
            for (data,) in rows(batches):
                symbols = np.frombuffer(data, np.uint16)
                for at in range(0, len(symbols), WINDOW):
                    yield None, symbols[at:at + WINDOW]

        for block in _blocks(runs(), BLOCK):
            starts, moves, emitted = expected(Lanes([s for _, s in block]), *shipped.value)
            total[:classes] += emitted
            total[classes] += starts
            total[classes + 1:] += moves
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(total[used, i]) for i in range(k)]], names=["r", *names])

    parts = staged.where("not held_out").select("classes").mapInArrow(summed, "r int, " + ", ".join(f"{n} double" for n in names))
    total = np.zeros((classes + 1 + k, k))
    for r, *values in parts.groupBy("r").agg(*[F.sum(n).alias(n) for n in names]).collect():  # classes + states + 1 rows
        total[r] = values
    shipped.unpersist()
    return total[classes], total[classes + 1:], total[:classes]


def train(staged: DataFrame, held: Tables, *, states: int = STATES, rounds: int = ROUNDS, seed: int = SEED) -> tuple:
    """(start, move, emit) after ``rounds`` of Baum-Welch from a seeded start; without training texts, the start itself."""
    draw = np.random.default_rng(seed)
    emit = held.unigram[:, None] * draw.gamma(0.5, size=(held.classes, states)) + 0.05 * held.unigram[:, None]
    emit /= emit.sum(0)
    start, move = np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    for _ in range(rounds if held.total else 0):
        starts, moves, emitted = _round(staged, (start, move, emit))
        start = (starts + 1) / (starts + 1).sum()
        move = (moves + 1) / (moves + 1).sum(1, keepdims=True)
        prior = 10.0 * held.unigram[:, None]
        emit = (emitted + prior) / (emitted + prior).sum(0)
    return start, move, emit


def likelihoods(staged: DataFrame, model: tuple) -> DataFrame:
    """The staged rows' numbers with ``log_classes``: log10 likelihood of the whole class sequence."""
    shipped = staged.sparkSession.sparkContext.broadcast(model)
    names = ["uid", "doc_id", "held_out", "n_tokens", "n_known", "log_counts", "log_within"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    schema = pa.schema([*zip(names, kinds), ("log_classes", pa.float64())])

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = ((r[:-1], np.frombuffer(r[-1], np.uint16)) for r in rows(batches))
        for block in _blocks(sequences, BLOCK):
            logs = forward(Lanes([s for _, s in block]), *shipped.value) / math.log(10)
            yield from batches_of(((*r, float(x)) for (r, _), x in zip(block, logs)), schema)

    return staged.select(*names, "classes").mapInArrow(scored, "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, "
                                                              "log_counts double, log_within double, log_classes double")


def score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", states: int = STATES, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Model and unigram log10 probabilities of every whole text, learnt from those that are not held out.

    A null text is empty: one end, nothing else. Null ids train; repeated rows are scored, and learnt from, each.
    An empty input gives no rows; without training texts every count is zero and the model is its seeded start.
    """
    texts = small_batches(docs).select(col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), text_or_empty(text).cast("binary").alias("t"))
    counts = stage_table(word_counts(texts.where("not held_out").select("t")))
    held = tables(counts)
    staged = stage_table(classified(texts, held).withColumn("uid", F.monotonically_increasing_id()))  # numbered once, then read back
    model = train(staged, held, states=states, rounds=rounds, seed=seed)
    scored = likelihoods(staged, model)
    # words that are rarer than every frequent one, so none of them is hot in training
    rare = (staged.select("uid", F.explode("rare").alias("word")).join(counts, "word", "left")
            .groupBy("uid").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_logs"), F.count("c").alias("rare_known")))
    every = F.col("log_counts") + F.coalesce("rare_logs", F.lit(0.0))
    return scored.join(rare, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(held.total).cast("long").alias("train_tokens"),
        (every - F.col("n_tokens") * math.log10(held.total + held.distinct + 1)).alias("base_score"),
        (F.col("log_classes") + F.col("log_within") + F.coalesce("rare_logs", F.lit(0.0))).alias("score"))
