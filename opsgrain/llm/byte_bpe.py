"""Byte-level BPE: overlapping chunks, stitched where pre-token boundaries agree again; decoding joins bytes.

The split pattern looks at most a few characters ahead and never back, so two scans of the same text
agree from the first boundary that they share. A long text is therefore cut into overlapping chunks that
are pre-tokenised and encoded in parallel tasks; neighbours are joined at a boundary that both have. Texts
of one chunk, nearly all, are encoded where they are read.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.llm.common import arrow_batch, batches_of, col, row_key, rows, small_batches, text_or_empty

CHUNK = 1 << 15  # characters a chunk stands for
OVERLAP = 1 << 10  # characters it reads beyond that
LOOK = 4  # the pattern's decisions need less than this many characters to the right
CACHE = 200_000  # pieces a worker remembers; a speed-up only


# Characters on which the standard library's classes mean what \p{L}, \p{N} and \s mean: Latin letters without
# raised digits, fractions and separators. Texts of these alone take the faster engine; the pieces are the same.
_OTHER = re.compile("[^\\x00-\\x1b\\x20-\\xb1\\xb4-\\xb8\\xba\\xbb\\xbf-\u024f\u2010-\u2026]")
_LATIN = {r"\p{L}+": r"[^\W\d_]+", r"\p{N}+": r"\d+", r"[^\s\p{L}\p{N}]+": r"(?:[^\s\w]|_)+"}


class Vocabulary:
    """Ranks of a byte-level vocabulary with the pattern that cuts texts into pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens = {i: t for t, i in ranks.items()}
        self.merge = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.pattern = regex.compile(pattern)
        self.latin = self.pattern
        parts = pattern.split("|")
        if all("p{" not in p or any(p.endswith(k) for k in _LATIN) for p in parts):
            for unicode_class, latin in sorted(_LATIN.items(), key=lambda kv: -len(kv[0])):
                parts = [p.replace(unicode_class, latin) for p in parts]
            self.latin = re.compile("|".join(parts))
        self.cache: dict[str, bytes] = {}

    def cuts(self, text: str):
        """The engine that pre-tokenises this text."""
        return self.pattern if _OTHER.search(text) else self.latin

    def packed(self, piece: str) -> bytes:
        """Ids of one pre-token as little-endian unsigned 32-bit integers."""
        ids = self.cache.get(piece)
        if ids is None:
            found = self.merge(piece)
            ids = struct.pack(f"<{len(found)}I", *found)
            if len(piece) <= 64:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        cache, packed = self.cache, self.packed
        return b"".join([cache.get(p) or packed(p) for p in self.cuts(text).findall(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))


@lru_cache(maxsize=2)
def vocabulary(name: str, pattern: str) -> Vocabulary:
    """Loaded once per worker from the file that Spark sent to every executor."""
    return Vocabulary(SparkFiles.get(name), pattern)


def _ship(spark: SparkSession, path: str) -> str:
    """Hand the vocabulary file (a fixed size of a few MB at most) to the executors; its name there."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def trusted(text: str, pattern: regex.Pattern | re.Pattern, last: bool) -> tuple[list[int], list[str]]:
    """Pre-tokens of a chunk that no text beyond its end could change: their starts and themselves."""
    starts, pieces = [], []
    size = len(text)
    for m in pattern.finditer(text):
        if not last and (m.end() >= size or m.start() > size - LOOK):
            break
        starts.append(m.start())
        pieces.append(m[0])
    return starts, pieces


def edges(text: str, start: int, last: bool, words: Vocabulary, chunk: int, overlap: int) -> tuple[list[int], list[int], bytes]:
    """What a chunk at ``start`` contributes: its ids, and the boundaries where it overlaps its neighbours,
    as positions in the whole text with the number of id bytes before them."""
    starts, pieces = trusted(text, words.cuts(text), last)
    coded = [words.packed(p) for p in pieces]
    places, before, done = [], [], 0
    for at, ids in zip(starts, coded):
        if at <= overlap or at >= chunk:
            places.append(start + at)
            before.append(done)
        done += len(ids)
    if pieces:
        places.append(start + starts[-1] + len(pieces[-1]))
        before.append(done)
    return places, before, b"".join(coded)


def stitch(chunks: list[tuple[list[int], list[int], bytes]]) -> bytes | None:
    """Ids of a text from what its chunks contribute, in order, or None if two neighbours share no boundary.

    The first chunk starts where the text starts, so its boundaries are right; a boundary that the next one
    shares hands over to it.
    """
    out: list[bytes] = []
    begin = chunks[0][0][0] if chunks[0][0] else None
    for k, (places, before, ids) in enumerate(chunks):
        mine = dict(zip(places, before))
        if begin not in mine:
            return None
        if k + 1 == len(chunks):
            out.append(ids[mine[begin]:])
            break
        after = set(chunks[k + 1][0])
        meet = next((p for p in places if p >= begin and p in after), None)
        if meet is None:
            return None
        out.append(ids[mine[begin]:mine[meet]])
        begin = meet
    return b"".join(out)


_CODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("data", pa.binary())])
_CHUNK = pa.schema([("key", pa.binary()), ("copies", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("places", pa.list_(pa.int64())),
                    ("before", pa.list_(pa.int64())), ("ids", pa.binary()), ("text", pa.string())])


def encode(docs: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP, decoded: bool = False) -> DataFrame:
    """(doc_id, ids): token ids of every whole text as little-endian unsigned 32-bit integers.

    With ``decoded`` the bytes that the ids stand for follow in ``data``, joined by the same worker. A null text is
    empty and has no ids; null ids and repeated rows pass through (repeated long rows are counted, so each
    keeps its own row). Only chunks of texts longer than one chunk are shuffled.
    """
    name = _ship(docs.sparkSession, path)
    schema = pa.schema(list(_CODED)[:3 if decoded else 2])
    ddl = "doc_id long, ids binary" + ", data binary" * decoded
    source = small_batches(docs).select(col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))

    def record(words: Vocabulary, i: int | None, ids: bytes) -> tuple:
        return (i, ids, words.decode(ids)) if decoded else (i, ids)

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name, pattern)
        yield from batches_of((record(words, i, words.encode(t)) for i, t in rows(batches)), schema)

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name, pattern)

        def records():
            for key, copies, i, start, last, t in rows(batches, 32):
                yield key, copies, i, start, *edges(t, start, last, words, chunk, overlap), t

        yield from batches_of(records(), _CHUNK, size=16)

    def join(table: pa.Table) -> pa.Table:
        words = vocabulary(name, pattern)
        found = table.sort_by("start").to_pylist()
        ids = stitch([(r["places"], r["before"], r["ids"]) for r in found])
        if ids is None:  # no shared boundary within an overlap, as in one endless run of letters: scan the text as a whole
            ids = words.encode("".join(r["text"][:chunk] for r in found))
        copies = found[0]["copies"]
        return pa.Table.from_batches([arrow_batch([record(words, found[0]["doc_id"], ids)] * copies, schema)])

    short = source.where(F.char_length("text") <= chunk).mapInArrow(whole, ddl)
    long = (source.where(F.char_length("text") > chunk).withColumn("key", row_key("doc_id", "text"))
            .groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("copies")))
    begin = F.explode(F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / chunk).cast("int"))).alias("k")
    pieces = (long.select("key", "copies", "doc_id", "text", begin)
              .select("key", "copies", "doc_id", (F.col("k") * chunk).cast("long").alias("start"),
                      (F.col("k") * chunk + chunk + overlap >= F.char_length("text")).alias("last"),
                      F.substring("text", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("text")))
    coded = pieces.repartition("key", "start").mapInArrow(
        parts, "key binary, copies long, doc_id long, start long, places array<long>, before array<long>, ids binary, text string")
    return short.unionByName(coded.groupBy("key").applyInArrow(join, ddl))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows with their bytes again in ``data``: the ids' byte strings, one after the other."""
    name = _ship(encoded.sparkSession, path)

    @F.arrow_udf(T.BinaryType())
    def back(ids: pa.Array) -> pa.Array:
        words = vocabulary(name, pattern)
        return pa.array([words.decode(i) for i in ids.to_pylist()], pa.binary())

    return encoded.withColumn("data", back("ids"))


def digest(docs: DataFrame, path: str, pattern: str, **more) -> DataFrame:
    """doc_id, n_tokens and the hashes of ids and decoded bytes of every text."""
    return encode(docs, path, pattern, decoded=True, **more).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))
