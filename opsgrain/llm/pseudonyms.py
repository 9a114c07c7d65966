"""Format-preserving pseudonyms for personal numbers and dates.

A value is found by its shape, validated (check digits, ranges, calendar) and replaced by the image of a keyed
Feistel permutation of its own format: a card number becomes another number of the same length with a
right check digit, a date another date written the same way. The permutation depends on the key, the
kind and the value alone, however it is written: a card with or without blanks, one day in any order of its
parts, one number with or without country code have one image, each in its own spelling. So equal values stay
linked across documents and nothing has to be stored or shuffled.

Two things stay visible, since spellings could not be read back otherwise: whether a date's day is above 12
(``25/03`` can only be day first), and a telephone number's country code and leading zero. Read as values are:
years 1900 to 2099; slashes are month first unless the first number is above 12, dots are day first; ten digits
without a plus are a North American number. Not read: written months, lower-case IBANs, social security numbers with blanks.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain.llm.common import col, small_batches

ROUNDS = 10
KINDS = ("email", "card", "iban", "ssn", "phone", "ipv4", "date")
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

# one scan: everything that starts at a digit, a plus, a bracket or two capitals, and addresses by their @
_SHAPES = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<ipv4>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))"
    r"|(?P<iso>(?<![\w/-])[0-9]{4}(?P<dash>[-/])[0-9]{2}(?P=dash)[0-9]{2}(?![0-9/-]))"
    r"|(?P<dmy>(?<![\w/.])[0-9]{1,2}(?P<cut>[/.])[0-9]{1,2}(?P=cut)[0-9]{4}(?![0-9]))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<card>(?<![\w+-])(?:[0-9]{13,19}|[0-9]{4}(?P<sep>[ -])[0-9]{4}(?P=sep)[0-9]{4}(?P=sep)[0-9]{1,4}(?:(?P=sep)[0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9]))"
    r"|(?P<phone>(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[.-])[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|(?<![\w+])\+[0-9](?:[ .-]?[0-9]){8,13}(?![0-9]))")
_DIGIT = re.compile(r"[0-9]")
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?)@((?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,})")


def feistel(key: bytes, kind: str, value: int, left: int, right: int) -> int:
    """Keyed permutation of range(left * right): a Feistel network over two unequal residues."""
    a, b = divmod(value, right)
    for r in range(ROUNDS):
        seed = f"{kind}|{left}|{right}|{r}|{a if r % 2 else b}".encode()
        pad = int.from_bytes(hashlib.blake2b(seed, key=key, digest_size=24).digest(), "big")
        if r % 2:
            b = (b + pad) % right
        else:
            a = (a + pad) % left
    return a * right + b


def permute(key: bytes, kind: str, value: int, size: int, valid: Callable[[int], bool] | None = None) -> int:
    """Keyed permutation of the valid members of range(size), by cycle walking."""
    left = max(1, round(size ** 0.5)) if size < 1 << 100 else 1 << (size.bit_length() // 2)
    right = -(-size // left)
    while True:
        value = feistel(key, kind, value, left, right)
        if value < size and (valid is None or valid(value)):
            return value


def luhn_digit(payload: str) -> int:
    """The check digit that completes a card number."""
    total = 0
    for i, d in enumerate(reversed(payload)):
        n = int(d) * (1 if i % 2 else 2)
        total += n - 9 if n > 9 else n
    return -total % 10


def _spread(shape: str, digits: str) -> str:
    """The digits in the places of the shape's digits."""
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in shape)


def _card(key: bytes, text: str) -> str | None:
    d = "".join(_DIGIT.findall(text))
    if len(d) < 13 or luhn_digit(d[:-1]) != int(d[-1]) or d[0] == "0":
        return None
    size = 10 ** (len(d) - 1)
    body = permute(key, f"card{len(d)}", int(d[:-1]), size, lambda v: v >= size // 10)
    body = str(body)
    return _spread(text, body + str(luhn_digit(body)))


def _iban_check(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def _iban(key: bytes, text: str) -> str | None:
    plain = text.replace(" ", "")
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(body) <= 30 or _iban_check(country, body) != check:
        return None
    body = _mixed(key, "iban" + country, body)
    out = iter(country + _iban_check(country, body) + body)
    return "".join(c if c == " " else next(out) for c in text)


def _mixed(key: bytes, kind: str, text: str) -> str:
    """Letters to letters of the same case, digits to digits, other characters as they are."""
    bases = [("0", 10) if "0" <= c <= "9" else ("A", 26) if "A" <= c <= "Z" else ("a", 26) if "a" <= c <= "z" else ("", 1) for c in text]
    value, size = 0, 1
    for c, (zero, n) in zip(text, bases):
        value, size = value * n + (ord(c) - ord(zero) if zero else 0), size * n
    shape = "".join(c if not z else z for c, (z, _) in zip(text, bases))
    value = permute(key, f"{kind}|{shape}", value, size) if size > 1 else 0
    out = []
    for c, (zero, n) in zip(reversed(text), reversed(bases)):
        value, digit = divmod(value, n)
        out.append(chr(ord(zero) + digit) if zero else c)
    return "".join(reversed(out))


def _ssn_ok(v: int) -> bool:
    area, group, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
    return area not in (0, 666) and area < 900 and group > 0 and serial > 0


def _ssn(key: bytes, text: str) -> str | None:
    v = int(text.replace("-", ""))
    return _spread(text, f"{permute(key, 'ssn', v, 10 ** 9, _ssn_ok):09d}") if _ssn_ok(v) else None


# fixed values: country codes of one and of two digits; all others have three
_SHORT_CODES = frozenset(("1", "7", *(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98").split()))


def _phone(key: bytes, text: str) -> str | None:
    """The number without its country code is permuted; what is written before it stays."""
    d = "".join(_DIGIT.findall(text))
    if not 10 <= len(d) <= 15:
        return None
    if text.startswith("+"):
        code = next(d[:n] for n in (1, 2, 3) if n == 3 or d[:n] in _SHORT_CODES)
        written = code
    else:  # without a plus a number starts with neither 0 nor 1
        if d[0] in "01":
            return None
        code, written = ("1" if len(d) == 10 else ""), ""
    rest = d[len(written):]

    def first(v: int) -> int:  # the kinds of numbers that must not become one another
        lead = v // 10 ** (len(rest) - 1)
        return min(lead, 2 if code in ("", "1") else 1)

    kind = first(int(rest))
    v = permute(key, f"phone{code}|{len(rest)}|{kind}", int(rest), 10 ** len(rest), lambda v: first(v) == kind)
    return _spread(text, written + f"{v:0{len(rest)}d}")


def _ipv4(key: bytes, text: str) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    v = 0
    for p in parts:
        v = v * 256 + int(p)
    v = permute(key, "ipv4", v, 1 << 32)
    return ".".join(str(v >> s & 255) for s in (24, 16, 8, 0))


def _day(year: int, month: int, day: int) -> int | None:
    try:
        n = datetime.date(year, month, day).toordinal()
    except ValueError:
        return None
    return n if FIRST_DAY <= n <= LAST_DAY else None


def _date(key: bytes, text: str, order: str) -> str | None:
    """A date in one of the written orders; the image keeps the order readable and the padding."""
    cut = re.search(r"[-/.]", text)[0]
    a, b, c = text.split(cut)
    padded = len(a) == 2 and len(b) == 2
    if order == "iso":
        n = _day(int(a), int(b), int(c))
    elif cut == "/" and int(a) <= 12:  # month first
        n, order = _day(int(c), int(a), int(b)), "mdy"
    else:
        n = _day(int(c), int(b), int(a))
    if n is None or (order != "iso" and not padded and "0" in (a[0], b[0])):
        return None
    d = _moved_day(key, n)
    if order == "iso":
        return f"{d.year:04d}{cut}{d.month:02d}{cut}{d.day:02d}"
    x, y = (d.month, d.day) if order == "mdy" else (d.day, d.month)
    return f"{x:02d}{cut}{y:02d}{cut}{d.year:04d}" if padded else f"{x}{cut}{y}{cut}{d.year:04d}"


def _moved_day(key: bytes, n: int) -> datetime.date:
    """The image of a day, the same for every spelling; days above 12 are permuted among themselves, and the others."""
    date = lambda v: datetime.date.fromordinal(FIRST_DAY + v)
    late = date(n - FIRST_DAY).day > 12
    return date(permute(key, f"date {late}", n - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, lambda v: (date(v).day > 12) == late))


def _email(key: bytes, local: str, domain: str) -> str:
    """The person's part is permuted; upper and lower case of it are one value."""
    return f"{_mixed(key, 'email@' + domain.lower(), local.lower())}@{domain}"


@lru_cache(maxsize=1 << 16)
def _image(key: bytes, shape: str, text: str) -> tuple[str, str] | None:
    kind = {"iso": "date", "dmy": "date"}.get(shape, shape)
    if kind == "date":
        out = _date(key, text, shape)
    else:
        out = {"card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "ipv4": _ipv4}[kind](key, text)
    return None if out is None else (kind, out)


def replace_values(text: str, key: bytes) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with its personal values replaced, and their spans in the text as it was."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        for m in _EMAIL.finditer(text):
            found.append((m.start(), m.end(), "email", _email(key, m[1], m[2])))
    at = 0
    if _DIGIT.search(text):
        while m := _SHAPES.search(text, at):
            shape = m.lastgroup
            value = m[0]
            image = _image(key, shape, value)
            while image is None and shape in ("card", "iban") and (cut := max(value.rfind(" "), value.rfind("-"))) > 0:
                value = value[:cut]  # the last group may be another number, or a word in capitals
                image = _image(key, shape, value)
            if image is None:
                at = m.start() + 1
                while at < m.end() and (text[at].isdigit() and text[at - 1].isdigit()):
                    at += 1  # a new value can't start inside a run of digits
                continue
            at = m.start() + len(value)
            found.append((m.start(), at, *image))
    found.sort()
    out, done, spans = [], 0, []
    for start, end, kind, image in found:
        if start < done:
            continue
        out += [text[done:start], image]
        spans.append((start, end, kind))
        done = end
    return ("".join(out) + text[done:] if found else text), spans


def pseudonymise(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", key: bytes) -> DataFrame:
    """doc_id, number of values per kind, their spans (kind:start:end in code points) and the new text.

    The key has 1 to 64 bytes and no default: who knows it can turn the pseudonyms back.
    A null text stays null and has no values; null ids and repeated rows pass through. One narrow pass.
    """
    if not 1 <= len(key) <= 64:
        raise ValueError("the key must have 1 to 64 bytes")

    @F.arrow_udf("struct<text: string, n_values: bigint, " + ", ".join(f"n_{k}: bigint" for k in KINDS) + ", spans: string>")
    def replaced(texts: pa.Array) -> pa.Array:
        news, totals, spans, kinds = [], [], [], {k: [] for k in KINDS}
        for value in texts.to_pylist():
            new, found = (None, []) if value is None else replace_values(value, key)
            news.append(new)
            totals.append(len(found))
            spans.append(",".join(f"{k}:{a}:{b}" for a, b, k in found))
            for k in KINDS:
                kinds[k].append(sum(f[2] == k for f in found))
        arrays = [pa.array(news, pa.string()), pa.array(totals, pa.int64()), *[pa.array(kinds[k], pa.int64()) for k in KINDS], pa.array(spans, pa.string())]
        return pa.StructArray.from_arrays(arrays, names=["text", "n_values", *[f"n_{k}" for k in KINDS], "spans"])

    found = small_batches(docs).select(col(doc_id).alias("doc_id"), replaced(col(text)).alias("found"))
    return found.select("doc_id", "found.n_values", *[f"found.n_{k}" for k in KINDS], "found.spans", "found.text")
