"""Shared column helpers: keyword rules, Python-compatible white space, JSON text, hashing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsgrain import rules


def as_col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def keyword_any(lowered: Column, keywords: Iterable[str]) -> Column:
    """True when any literal keyword occurs.

    A chain of ``contains`` scans bytes and is about three times as fast as one pattern. Pass
    a column of an earlier projection that already is lower case: with the lowering inside,
    every keyword would lower the text again and the generated code would outgrow the JVM's
    limit.
    """
    return reduce(lambda a, b: a | b, [lowered.contains(w) for w in keywords])


def first_match(branches: Iterable[tuple[Column, object]], default: Column | object) -> Column:
    """First branch whose condition holds, in order."""
    chain = None
    for cond, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(cond, value) if chain is None else chain.when(cond, value)
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def lookup(key: Column, mapping: Mapping, default=None) -> Column:
    """Literal map lookup; null for an unmapped key unless a default is given."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def strip(col: Column | str) -> Column:
    """Python's ``str.strip``: every white-space character, not only the blank."""
    return F.btrim(as_col(col), F.lit(rules.SPACE_CHARS))


def normalize_whitespace(col: Column | str) -> Column:
    """Runs of white space to one blank, none at the ends; single blanks are not touched."""
    return F.trim(F.regexp_replace(F.coalesce(as_col(col), F.lit("")), rules.JAVA_UNEVEN_SPACE, " "))


def word_count(col: Column | str) -> Column:
    return F.regexp_count(as_col(col), F.lit(rules.JAVA_NON_SPACE))


def explode_rows(df, array: Column, name: str, *keep: str):
    """One row per array item. The outer form with a later filter keeps Spark from testing the
    size of the array in front of it, which would compute an expensive array twice."""
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def occurrences(text: Column, literal: str) -> Column:
    """Non-overlapping occurrences of a literal, without the regex engine."""
    removed = F.replace(text, F.lit(literal), F.lit(""))
    return ((F.length(text) - F.length(removed)) / F.lit(len(literal))).cast("int")


def safe_str(col: Column | str) -> Column:
    """Trimmed text; null and the text form of NaN become the empty string."""
    text = strip(as_col(col).cast("string"))
    return F.when(F.lower(text).rlike(r"^[+-]?nan$"), F.lit("")).otherwise(F.coalesce(text, F.lit("")))


def combine_ts(*parts: Column | str) -> Column:
    """Join the non-blank parts with one space."""
    kept = [F.when(strip(as_col(p)) != "", as_col(p)) for p in parts]
    return F.concat_ws(" ", *kept)


def json_text(col: Column | str) -> Column:
    """A JSON string literal for a text column, e.g. ``"a\\n"``; null gives ``null``."""
    text = as_col(col)
    wrapped = F.to_json(F.struct(text.alias("v")))
    return F.when(text.isNull(), F.lit("null")).otherwise(
        F.substring(wrapped, F.lit(6), F.length(wrapped) - 6))


def json_object(**fields: Column | str) -> Column:
    """``{"k": "v", ...}`` with one blank after colons and commas."""
    parts: list[Column] = []
    for i, (name, col) in enumerate(fields.items()):
        parts += [F.lit(("{" if i == 0 else ", ") + f'"{name}": '), json_text(col)]
    return F.concat(*parts, F.lit("}"))


def json_valid(col: Column | str) -> Column:
    """Strict whole-string JSON, as Python's parser sees it: ``NaN`` and ``Infinity`` are numbers, keys may repeat.

    Spark's JSON readers stop at the end of the first value and so accept trailing
    text. Parsing the text once inside ``[...]`` and once inside ``{"k":...}`` closes
    that gap: trailing text that satisfies one wrapper breaks the other. The readers
    also take single-quoted strings and raw control characters in strings. One possessive
    pattern removes the well-formed string literals; no quote of either kind may be left.
    """
    s = as_col(col)
    # the look-behind is tried at every character, so texts without either word go round it
    number = F.when(s.contains("Infinity") | s.contains("NaN"),
                    F.regexp_replace(s, r"(?<=^|[\[,:\s])(?:-?Infinity|NaN)(?=$|[\],}\s])", "0")).otherwise(s)
    in_array = F.json_array_length(F.concat(F.lit("["), number, F.lit("]"))) == 1
    in_object = F.size(F.json_object_keys(F.concat(F.lit('{"k":'), number, F.lit("}")))) == 1
    plain = ~F.regexp_replace(s, rules.JAVA_JSON_STRING, "0").rlike("[\"']")
    return F.coalesce(in_array & in_object & plain, F.lit(False))


def md5_mod(col: Column | str, modulus: int) -> Column:
    """md5 read as one 128-bit integer, modulo ``modulus`` (Horner over 8-digit chunks)."""
    digest = F.md5(as_col(col))
    base = (16 ** 8) % modulus
    value = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        chunk = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        value = (value * F.lit(base) + chunk) % F.lit(modulus)
    return value


def stable_hash_keep(system: Column | str, raw_id: Column | str, pct: int = 10) -> Column:
    """Deterministic sample: the same ids are kept on every run and cluster."""
    return md5_mod(F.concat(as_col(system), F.lit(":"), as_col(raw_id)), 100) < pct


def seeded_key(seed: int, *cols: Column | str) -> Column:
    """A uniform, reproducible sort key; unique when the columns are."""
    ident = F.concat_ws(":", F.lit(str(seed)), *[as_col(c).cast("string") for c in cols])
    return F.concat(F.md5(ident), F.lit(":"), ident)


def seeded_int(seed: int, *cols: Column | str) -> Column:
    """60 bits of a seeded md5 as a non-negative bigint."""
    ident = F.concat_ws(":", F.lit(str(seed)), *[as_col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(ident), 1, 15), 16, 10).cast("bigint")


def py_round(col: Column | str, digits: int) -> Column:
    """Python's ``round``: half to even on the exact binary value.

    Spark rounds the shortest decimal text half up, which differs for 0.03125 or 2.675. The
    candidate digit is found in floating point; when it is a 5, the exact remainder decides,
    computed without error by splitting the fraction into two halves of 26 bits. Pass a column
    of an earlier projection rather than an expression: it is used several times.
    """
    v = as_col(col).cast("double")
    size = F.abs(v)
    whole = F.floor(size).cast("double")
    frac = size - whole
    tens, unit = float(10 ** (digits + 1)), float(10 ** digits)
    digit = F.floor(frac * tens + 0.5).cast("double")
    split = frac * 134217729.0
    high = split - (split - frac)
    rest = (high * tens - digit) + (frac - high) * tens
    below = whole * unit + (digit - 5.0) / 10.0
    tie = F.when(rest > 0, below + 1.0).when(rest < 0, below).otherwise(below + F.pmod(below, F.lit(2.0)))
    nearest = whole * unit + F.floor((digit + 5.0) / 10.0)
    scaled = F.when(F.pmod(digit, F.lit(10.0)) == 5.0, tie).otherwise(nearest)
    return F.when(size >= 2.0 ** 52 / tens, v).otherwise(F.signum(v) * scaled / unit)


def np_round(col: Column | str, digits: int) -> Column:
    """NumPy's ``round``: scale, round half to even, scale back."""
    unit = float(10 ** digits)
    return F.rint(as_col(col).cast("double") * unit) / unit
