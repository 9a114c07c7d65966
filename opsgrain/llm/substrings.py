"""Exact removal of repeated passages with suffix automata of reference shards.

The reference is the corpus itself, so its automata have no bounded size and can't be broadcast whole. Instead
every window of words is routed by its minimizer, the smallest hash of its eight-word grams: equal windows
have equal minimizers. Minimizers that occur once cannot belong to a repeated window; a broadcast Bloom filter
of bounded size, built from those that repeat, drops most of the text before anything but hashes moves. Runs of
windows with one minimizer meet in one group. There the distinct runs form reference shards of bounded size;
each shard becomes a suffix automaton with occurrence counts, and all runs of the group are streamed through it
for their matching statistics. The hits of all shards add up. Minimizers with very many occurrences are not
gathered: their windows are counted one by one, spread by the windows' own hashes.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain.llm.common import batches_of, col, row_key, rows, small_batches, text_or_empty
from opsgrain.session import stage_table

LENGTH = 35  # words of a window
GRAM = 8  # words of a gram; a window shorter than this is its own gram
PART = 1 << 17  # windows of a text that are handled at once
SHARD = 500  # distinct runs in one automaton
GATHERED = 10_000  # occurrences of a minimizer beyond which its windows are counted singly
MAX_BITS = 1 << 26  # of the broadcast filter: 8 MB
FLUSH = 500_000

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_STEP = 0x9E3779B97F4A7C15


def runs(words: Sequence[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Minimizers, first windows, ends (exclusive) and gram counts (1, or 2 for more) of the runs of windows
    that share a minimizer; long texts come in several parts, each window in one of them."""
    gram = min(GRAM, length)
    span = length - gram + 1  # grams of a window
    total = len(words) - length + 1
    for begin in range(0, max(0, total), PART):
        n = min(PART, total - begin)
        some = words[begin:begin + n + length - 1]
        h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, some)), ">u8").astype(np.uint64)
        g = np.zeros(len(some) - gram + 1, np.uint64)
        for k in range(gram):
            g += h[k:k + len(g)] * np.uint64(pow(_STEP, k + 1, 1 << 64))
        g ^= g >> np.uint64(29)
        g *= _MIX
        g ^= g >> np.uint64(32)
        low, width = g, 1  # low[i]: the smallest of width grams from i
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[:n], low[span - width:span - width + n])
        first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        end = np.append(first[1:], n)
        value = low[first]
        at = np.arange(span)
        left = first + np.argmax(g[first[:, None] + at] == value[:, None], axis=1)
        right = end - 1 + span - 1 - np.argmax(g[(end - 1)[:, None] + at[::-1]] == value[:, None], axis=1)
        yield value.view(np.int64), begin + first, begin + end, 1 + (left != right)


class Automaton:
    """Suffix automaton of weighted word strings; ``count`` is how often a state's strings occur."""

    def __init__(self, strings: Iterable[tuple[Sequence[bytes], int]]):
        follow, link, size, count = [{}], [-1], [0], [0]
        for words, weight in strings:
            last = 0
            for w in words:
                p, known = last, follow[last].get(w)
                if known is None:
                    last = len(size)
                    follow.append({})
                    link.append(0)
                    size.append(size[p] + 1)
                    count.append(weight)
                    while p >= 0 and w not in follow[p]:
                        follow[p][w] = last
                        p = link[p]
                    if p < 0:
                        continue
                    known = follow[p][w]
                    if size[known] == size[p] + 1:
                        link[last] = known
                        continue
                elif size[known] == size[p] + 1:
                    last = known
                    count[known] += weight
                    continue
                else:
                    last = -1
                copy = len(size)
                follow.append(dict(follow[known]))
                link.append(link[known])
                size.append(size[p] + 1)
                count.append(0)
                while p >= 0 and follow[p].get(w) == known:
                    follow[p][w] = copy
                    p = link[p]
                link[known] = copy
                if last < 0:
                    last = copy
                    count[copy] += weight
                else:
                    link[last] = copy
        for state in sorted(range(1, len(size)), key=size.__getitem__, reverse=True):
            count[link[state]] += count[state]
        self.follow, self.link, self.size, self.count = follow, link, size, count

    def occurrences(self, words: Sequence[bytes], length: int) -> list[int]:
        """For every window of ``length`` words, how often the automaton's strings hold it.

        The state is the longest match that ends at a word, cut to the window's length.
        """
        follow, link, size, count = self.follow, self.link, self.size, self.count
        state, matched, out = 0, 0, []
        for i, w in enumerate(words):
            while state and w not in follow[state]:
                state = link[state]
                matched = size[state]
            state = follow[state].get(w, 0)
            matched = matched + 1 if state else 0
            while state and size[link[state]] >= length:
                state = link[state]
                matched = size[state]
            if i >= length - 1:
                out.append(count[state] if matched >= length else 0)
        return out


def repeated(group: Counter, length: int = LENGTH, shard: int = SHARD) -> dict[bytes, list[int]]:
    """Windows of each distinct run (words joined by a space) that the weighted runs of a group hold twice or more."""
    if len(group) == 1:
        (run, times), = group.items()
        if times > 1:
            return {run: list(range(run.count(b" ") + 2 - length))}
        words = run.split(b" ")
        n = len(words) - length + 1
        if len(set(words[:n])) == n:  # equal windows would start with equal words
            return {}
    strings = {run: run.split(b" ") for run in group}
    totals = {run: [0] * (len(words) - length + 1) for run, words in strings.items()}
    names = list(group)
    for at in range(0, len(names), shard):
        reference = Automaton((strings[run], group[run]) for run in names[at:at + shard])
        for run, words in strings.items():
            totals[run] = [a + b for a, b in zip(totals[run], reference.occurrences(words, length))]
    return {run: [i for i, times in enumerate(t) if times > 1] for run, t in totals.items()}


def _minimizers(texts: DataFrame, length: int) -> DataFrame:
    """(m, times) of the minimizers that occur twice or more."""
    schema = pa.schema([("m", pa.int64()), ("n", pa.int32())])

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            values = np.concatenate([v for v, _ in held])
            unique, place = np.unique(values, return_inverse=True)
            times = np.bincount(place, np.concatenate([t for _, t in held])).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(unique), pa.array(times)], schema=schema)

        for (text,) in rows(batches):
            for values, _, _, times in runs(text.split(), length):
                held.append((values, times))
                size += len(values)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return texts.mapInArrow(counted, "m long, n int").groupBy("m").agg(F.sum("n").alias("times")).where("times > 1")


def _filter(minimizers: DataFrame) -> tuple[np.ndarray, int]:
    """Bloom filter of two bits per minimizer as words of 64 bits; at most MAX_BITS bits reach the driver."""
    bits = 1 << 16
    while bits < MAX_BITS and bits < 16 * minimizers.count():
        bits *= 2
    place = F.explode(F.array(F.pmod("m", F.lit(bits)), F.pmod(F.shiftright("m", 32), F.lit(bits)))).alias("p")
    found = (minimizers.select(place).groupBy(F.shiftright("p", 6).alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("word")).toArrow())
    words = np.zeros(bits // 64, np.uint64)
    words[found["at"].to_numpy()] = found["word"].to_numpy().astype(np.int64).view(np.uint64)
    return words, bits


def _hits(words: np.ndarray, bits: int, values: np.ndarray) -> np.ndarray:
    def test(p):
        return words[p >> 6] >> (p & 63).astype(np.uint64) & np.uint64(1)
    return (test(values % bits) & test((values >> 32) % bits)).astype(bool)


def _segments(docs: DataFrame, minimizers: DataFrame, length: int) -> DataFrame:
    """(m, key, at, words): runs whose minimizer may repeat, with the words that their windows span."""
    bloom, bits = _filter(minimizers)
    shipped = docs.sparkSession.sparkContext.broadcast(bloom)
    schema = pa.schema([("m", pa.int64()), ("key", pa.binary()), ("at", pa.int64()), ("words", pa.binary())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for key, text in rows(batches):
                words = text.split()
                for values, first, end, _ in runs(words, length):
                    for i in np.flatnonzero(_hits(shipped.value, bits, values)).tolist():
                        a = int(first[i])
                        yield int(values[i]), key, a, b" ".join(words[a:int(end[i]) + length - 1])
        yield from batches_of(records(), schema, size=4096)

    return docs.mapInArrow(cut, "m long, key binary, at long, words binary")


def _spans(key: bytes, at: int, windows: Iterable[int], length: int) -> Iterator[tuple[bytes, int, int]]:
    """Maximal word ranges that consecutive windows cover."""
    start = end = None
    for i in windows:
        if start is None or i > end:
            if start is not None:
                yield key, at + start, at + end + length - 1
            start = i
        end = i + 1
    if start is not None:
        yield key, at + start, at + end + length - 1


_SPANS = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("stop", pa.int64())])
_SPANS_DDL = "key binary, first long, stop long"


def _matched(segments: DataFrame, length: int) -> DataFrame:
    """Spans of repeated windows, group by group, from segments that lie together by minimizer."""
    def matched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for _, group in groupby(rows(batches), key=lambda r: r[0]):
                places = [(key, at, words) for _, key, at, words in group]
                found = repeated(Counter(w for _, _, w in places), length)
                for key, at, words in places:
                    yield from _spans(key, at, found.get(words, ()), length)
        yield from batches_of(records(), _SPANS, size=8192)

    return segments.repartition("m").sortWithinPartitions("m").mapInArrow(matched, _SPANS_DDL)


def _counted(segments: DataFrame, length: int) -> DataFrame:
    """The same spans for minimizers that occur too often to be gathered: windows counted by their own 128 bits."""
    schema = pa.schema([("w", pa.binary()), ("key", pa.binary()), ("first", pa.int64())])

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for _, key, at, run in rows(batches):
                words = run.split(b" ")
                for i in range(len(words) - length + 1):
                    yield hashlib.md5(b" ".join(words[i:i + length])).digest(), key, at + i
        yield from batches_of(records(), schema, size=8192)

    each = segments.mapInArrow(windows, "w binary, key binary, first long")
    twice = each.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w")
    return each.join(twice, "w", "left_semi").select("key", "first", (F.col("first") + length).alias("stop"))


def repeated_spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gathered: int = GATHERED) -> DataFrame:
    """(key, first, stop): word ranges of the rows, told apart by id and text, that repeated windows cover."""
    texts = small_batches(docs).select(row_key(doc_id, text).alias("key"), text_or_empty(text).cast("binary").alias("t"))
    minimizers = stage_table(_minimizers(texts.select("t"), length))
    segments = _segments(texts, minimizers, length)
    often = stage_table(minimizers.where(F.col("times") > gathered).select("m"))
    spans = _matched(segments.join(often, "m", "left_anti"), length)
    if often.isEmpty():
        return spans
    # counted and then looked up, so they are cut from the texts once
    return spans.unionByName(_counted(stage_table(segments.join(often, "m", "left_semi")), length))


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gathered: int = GATHERED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every word that a repeated window covers is gone, the rest joined by spaces.

    A null text has no words; null ids are fine; rows equal in id and text repeat each other. An empty input gives no rows.
    """
    spans = repeated_spans(docs, doc_id=doc_id, text=text, length=length, gathered=gathered)
    sets = spans.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("first", "stop"))).alias("spans"))  # within one text
    whole = docs.select(col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("key"), text_or_empty(text).cast("binary").alias("t"))
    joined = whole.join(sets, "key", "left").select("doc_id", "t", F.col("spans.first").alias("first"), F.col("spans.stop").alias("stop"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for doc_id, t, first, stop in rows(batches):
                words = t.split()
                kept, done = [], 0
                for a, b in zip(first or (), stop or ()):
                    if b > done:
                        kept += words[done:max(a, done)]
                        done = b
                kept += words[done:]
                yield doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()
        yield from batches_of(records(), schema, size=2048)

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
