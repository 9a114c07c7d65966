"""Secret scans: fixed patterns, plus literals that are assigned to sensitively named targets.

A lexer reads the assignments of source code and configuration (see ``assignments``), follows constants through
names, concatenations and calls (``A = "x"``; ``password = PREFIX + A``) back from the sensitive targets, and scores
each literal by the most sensitive name that it reaches and by its own shape. Time is linear in the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.llm.common import col, small_batches, text_or_empty

# fixed values: the base patterns and the shortest match that counts
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of HEX is matched whole, so its length can be asked for at once
KINDS = ("assign", "access", "hex", "literal")

SENSITIVE = {"password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "secret": 3, "token": 3, "apikey": 3, "credential": 3,
             "credentials": 3, "auth": 2, "signature": 2, "key": 1, "pass": 2, "private": 2, "access": 1, "client": 1, "jwt": 3,
             "bearer": 3, "cookie": 2, "session": 1}
HARMLESS = {"none", "null", "true", "false", "changeme", "example", "test", "todo", "undefined", "string", "password", "secret", "token"}
MIN_SCORE = 6

# the lexer: every pattern is anchored or ends at the line, and what a token consumed is not read again
_BODY = r"""(?P<{0}>[rRbBuUfF]{{0,2}}(?:\"\"\".*?\"\"\"|\'\'\'.*?\'\'\'|"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`(?:[^`\\\n]|\\.)*+`))"""
_STRING = re.compile(_BODY.format("s"), re.S)
_TOKEN = re.compile(r"(?P<escape>\\.)|(?<!\w)" + _BODY.format("string") + r"|<(?P<tag>[A-Za-z_][\w.:-]*)(?:[ \t][^<>]*)?>(?P<inside>[^<]*)</(?P=tag)[ \t]*>"
                    r"|(?<![\w.$-])(?P<name>[A-Za-z_$][\w.$-]*+)(?=[ \t]*[:=?|+\[])", re.S)
_SUBSCRIPT = re.compile(r"""\[[ \t]*:?(?:"([\w.$ -]+)"|'([\w.$ -]+)'|([A-Za-z_]\w*))[ \t]*\]""")
_TYPE = r"""(?::[ \t]*[A-Za-z_][\w.]*(?:\[[^\[\]\n=]*\]|<[^<>\n=]*>)?(?:[ \t]*\|[ \t]*\w+)*[ \t]*(?==(?![=>~])))?"""
_BECOMES = re.compile(r"[ \t]*" + _TYPE + r"(?::=|=>|\|\|=|\?\?=|\?=|\+=|=(?![=>~])|:(?![:/]))[ \t]*")
_CHAIN = re.compile(r"([A-Za-z_$][\w.$-]*)(?=(?:[ \t]+:?=[ \t]+|:?=)[^\s=>&]|:[ \t]+\S)")
_BLOCK = re.compile(r"[|>][+-]?[1-9]?[+-]?[ \t]*(?:#[^\n]*)?\n")
_LINE = re.compile(r"([ \t]*)([^\n]*)(?:\n|\Z)")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|\.|\\?\n[ \t]*\+)?\s*")  # pieces of one literal; a line may end inside brackets
_OTHER = re.compile(r"[ \t]*(?:\?\?|\|\||&&|\?:|\?|:|or\b|and\b|if\b|else\b|,)[ \t]*")  # alternatives
_BARE = re.compile(r"(?:[^\s\"'`,;(){}\[\]<>\\]|\\.)+")
_IDENT = re.compile(r"[A-Za-z_$][\w.$-]*\Z")
_ALONE = re.compile(r"[A-Za-z_$][\w$-]*(?=[\r\n;,]|\Z)")  # a value that is one name
_WORD = re.compile(r"[A-Za-z_$][\w.$]*")
_KEY = re.compile(r"[A-Za-z_$][\w.$ -]*\Z")
_INNER = re.compile(r"(?<![\w.$-])([A-Za-z_$][\w.$-]*)=((?:[^\s\"'`;=&\\]|&(?!\w+=)|=(?![\w]))+)")  # name=value inside a string
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of the base patterns, whole matches, leftmost and non-overlapping per kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass(slots=True)
class Pair:
    """What one assignment says: its target, the literals (spans of their pieces) and the names that flow into it."""

    name: str
    literals: list[list[tuple[int, int]]]
    sources: list[str]
    bare: str = ""  # the text of a value that may be a name or an unquoted literal


def _inside(m: re.Match) -> tuple[int, int]:
    """The span of a string's content, without its prefix and quotes."""
    start, end = m.span(m.lastgroup)
    while m.string[start] not in "\"'`":
        start += 1
    quotes = 3 if end - start >= 6 and m.string[start:start + 3] in ('"""', "\'\'\'") else 1
    return start + quotes, end - quotes


def _block(text: str, at: int, line: int) -> list[tuple[int, int]]:
    """Lines of a YAML block scalar: those deeper than the line of its key, which starts at ``line``."""
    depth = _LINE.match(text, line).end(1) - line
    pieces = []
    while at < len(text):
        m = _LINE.match(text, at)
        if m[2].strip() and m.end(1) - at <= depth:
            break
        if m[2].strip():
            pieces.append((m.start(2), m.start(2) + len(m[2].rstrip())))
        at = m.end()
    return pieces


def _value(text: str, at: int, start: int, pair: Pair) -> int:
    """Reads one right-hand side into the pair; the position from which to read on."""
    if name := _ALONE.match(text, at):
        pair.bare, pair.literals = name[0], [[name.span()]]
        pair.sources.append(name[0])
        return name.end()
    if text[at:at + 1] in ("|", ">") and (block := _BLOCK.match(text, at)):
        pair.literals.append(_block(text, block.end(), text.rfind("\n", 0, start) + 1))
        return block.end()  # the lines may be code themselves
    if chain := _CHAIN.match(text, at):
        pair.sources.append(chain[1])
        return at
    depth, alone, new, called = 0, True, True, False
    while at < len(text):
        if text[at] == "(":
            depth, at, new = depth + 1, at + 1, True
            continue
        if depth and text[at] in ") \t\r\n":
            depth, at = depth - (text[at] == ")"), at + 1
            continue
        if string := _STRING.match(text, at):
            span, at, alone = _inside(string), string.end(), False
            if not called or _BARE.fullmatch(text, *span):
                if new:
                    pair.literals.append([])
                pair.literals[-1].append(span)
                new = False
        elif alone and not depth and (bare := _BARE.match(text, at)):
            end = bare.end()
            while end > at and text[end - 1] in (".:+" if text[end:end + 1] in ("'", '"') else ".:"):
                end -= 1
            if end == at:
                return bare.end()
            word = text[at:end]
            if _IDENT.match(word):
                pair.sources.append(word)
            pair.bare, pair.literals, at, alone = word, [[(at, end)]], end, False
            new = True
        elif word := _WORD.match(text, at):
            pair.sources.append(word[0])
            at = word.end()
        elif depth == 0:
            break
        else:
            at, new = at + 1, True
            continue
        if at < len(text) and text[at] == "(":
            called = True
            continue
        if step := _OTHER.match(text, at):
            if text[step.end():step.end() + 1] == "\n" or (step[0].strip() == "," and not depth):
                break
            at, new = step.end(), True
            if not (_STRING.match(text, at) or _WORD.match(text, at)):
                break
            continue
        join = _JOIN.match(text, at)
        after = join.end()
        if "+" in join[0] or "." in join[0] or depth:
            at = after
        elif "\n" not in join[0] and _STRING.match(text, after):
            at = after  # neighbours
        else:
            break
        if pair.bare and "+" not in join[0]:
            break
    return at


def assignments(text: str) -> list[Pair]:
    """The assignments of a source or configuration text, in one pass.

    A target is a name, a quoted key, a subscript by a constant (``c["k"]``) or an XML element. Values are
    strings (triple and raw ones, too), their concatenations and alternatives, YAML block
    scalars, bare words; arguments of a call count where they hold no blank, quote or bracket. Comments are read like code, since a disabled assignment leaks its secret all the same;
    inside strings only ``name=value`` without blanks (connection strings, addresses) counts as an assignment.
    """
    pairs: list[Pair] = []

    def inner(start: int, end: int) -> None:
        for m in _INNER.finditer(text, start, end):
            pairs.append(Pair(m[1], [[m.span(2)]], [m[2]] if _IDENT.match(m[2]) else [], m[2]))

    at = 0
    while m := _TOKEN.search(text, at):
        kind, start, at = m.lastgroup, m.start(), m.end()
        if kind == "inside":
            kind, name = "tag", m["tag"]
        elif kind == "name":
            name = m["name"]
            while text[at:at + 1] == "[" and (part := _SUBSCRIPT.match(text, at)):
                name, at = f"{name}.{part[part.lastindex]}", part.end()
        elif kind == "string":
            a, b = _inside(m)
            name = text[a:b] if b - a <= 200 and _KEY.match(text[a:b]) else ""
        else:
            continue
        if kind == "tag":
            a, b = m.span("inside")
            value = text[a:b]
            a, b = a + len(value) - len(value.lstrip()), b - (len(value) - len(value.rstrip()))
            if a < b:
                pairs.append(Pair(name, [[(a, b)]], [], ""))
            inner(*m.span("inside"))
            continue
        becomes = _BECOMES.match(text, at) if name else None
        if becomes is None:
            if kind == "string":
                inner(*_inside(m))
            continue
        pair = Pair(name, [], [])
        at = _value(text, becomes.end(), start, pair)
        if pair.literals or pair.sources:
            pairs.append(pair)
            for pieces in pair.literals:
                for a, b in () if pair.bare else pieces:
                    inner(a, b)
    return pairs


def hinted(text: str) -> bool:
    """Whether a name in the text can score at all."""
    low = text.lower()
    return any(word in low for word in SENSITIVE)


def name_score(name: str) -> int:
    """How sensitive a target's name is: its most telling word, more for pairs like api key or private key."""
    if not hinted(name):
        return 0
    parts = [p.lower() for p in _PARTS.findall(name)]
    best = max((SENSITIVE.get(p, 0) for p in parts), default=0)
    joined = "".join(parts)
    if "apikey" in joined or ("key" in parts and {"private", "access", "secret", "client"} & set(parts)):
        best = 3
    return best


def literal_score(value: str) -> int:
    """How much a literal looks like a credential by length, alphabet and entropy."""
    low = value.lower()
    if len(value) < 6 or low in HARMLESS or len(set(low)) < 4 or value.startswith(("${", "{{", "<", "%(", "$(")):
        return -9
    counts = Counter(value)
    entropy = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return (len(value) >= 8) + (len(value) >= 16) + (entropy >= 3) + (classes >= 2 and bool(re.search("[0-9]", value)))


def reached(pairs: list[Pair]) -> dict[str, int]:
    """For every name the score of the most sensitive name that its value flows into, in one walk against the flow."""
    sources: dict[str, list[str]] = {}
    for pair in pairs:
        sources.setdefault(pair.name, []).extend(pair.sources)
    best: dict[str, int] = {}
    for start in sorted(sources, key=name_score, reverse=True):
        score, todo = name_score(start), [start]
        while todo:
            name = todo.pop()
            if name not in best:
                best[name] = score
                todo += sources.get(name, ())
    return best


def literal_spans(text: str) -> list[tuple[int, int]]:
    """Literals whose score, own shape plus the most sensitive name that they reach, is high enough."""
    if ("=" not in text and ":" not in text and "</" not in text) or not hinted(text):
        return []
    pairs = assignments(text)
    reach = reached(pairs)
    defined = {p.name for p in pairs if p.literals and not (p.bare and p.sources)}
    spans = []
    for pair in pairs:
        if reach[pair.name] == 0:
            continue
        for i, pieces in enumerate(pair.literals):
            if i == 0 and pair.bare and pair.sources and (pair.bare in defined or not re.search(r"\d", pair.bare)):
                continue  # a name, not a literal
            if reach[pair.name] + literal_score("".join(text[a:b] for a, b in pieces)) >= MIN_SCORE:
                spans += [(a, b) for a, b in pieces if b > a]
    return spans


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_text(text: str) -> tuple[int, int, int, str, str]:
    base = base_spans(text)
    # a base pattern may end inside a literal; only one that covers the literal whole makes it superfluous
    starts, ends = [s for s, _, _ in base], list(accumulate((e for _, e, _ in base), max))
    more = []
    for a, b in dict.fromkeys(literal_spans(text)):
        before = bisect_right(starts, a)
        if not before or ends[before - 1] < b:
            more.append((a, b, "literal"))
    every = sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]), s[1])) if more else base
    count = Counter(kind for _, _, kind in base)
    plain = joined(base)
    return count["assign"], count["access"], count["hex"], hashlib.sha256(plain.encode()).hexdigest(), joined(every) if more else plain


_FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")]
                      + [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")])


@F.arrow_udf(_FOUND)
def _scan(texts: pa.Array) -> pa.Array:
    columns = list(zip(*map(scan_text, texts.to_pylist()))) or [()] * 5
    kinds = [pa.int64()] * 3 + [pa.string()] * 2
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=_FOUND.names)


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and spans of secrets in every text; positions are code points, ends exclusive.

    A null text is empty; null ids and repeated rows pass through; one narrow pass without a shuffle.
    """
    found = small_batches(docs).select(col(doc_id).alias("doc_id"), _scan(text_or_empty(text)).alias("found"))
    return found.select("doc_id", "found.*")
