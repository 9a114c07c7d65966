"""Code files: classifiers, licences, redaction, prompts, wrapping, YAML validity."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain import rules
from opsgrain.functions.core import as_col, first_match, json_text, keyword_any, strip


def size_bucket(n: Column | str) -> Column:
    n = as_col(n)
    return first_match([(n < 1_000, "<1KB"), (n < 10_000, "1-10KB"), (n < 100_000, "10-100KB")], ">100KB")


def iac_type(content: Column | str, with_terraform: bool = True, head: int | None = None) -> Column:
    """Kind of manifest, judged by the whole text or by as many characters as ``head`` says."""
    head = as_col(content) if head is None else F.substring(as_col(content), 1, head)
    branches = [(head.rlike(p), name) for name, p in rules.IAC_RULES]
    if with_terraform:
        branches.append((head.rlike(rules.TERRAFORM_PATTERN), "terraform"))
    return first_match(branches, "other")


def escape_score(content: Column | str) -> Column:
    c = as_col(content)

    def count(char: str) -> Column:
        return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))

    return count("\n") + count('"') * 2 + count("\\") * 3


def escape_difficulty(score: Column | str) -> Column:
    """How much escaping a JSON string of the text needs, from its ``escape_score``."""
    score = as_col(score)
    return first_match([(score > 5000, "hard"), (score > 1000, "medium")], "easy")


def prompt_type(prompt: Column | str) -> Column:
    low = F.lower(as_col(prompt))
    return first_match([(low.contains(k), k) for k in rules.PROMPT_TYPES], "fallback")


def collect_licenses(*arrays: Column | str) -> Column:
    """All licence names of the given arrays, blanks dropped, trimmed, lower-cased, in order."""
    empty = F.array().cast("array<string>")
    merged = F.concat(*[F.coalesce(as_col(a), empty) for a in arrays])
    named = F.filter(merged, lambda x: x.isNotNull() & (strip(x) != ""))
    return F.transform(named, lambda x: F.lower(strip(x)))


def license_class(licenses: Column | str) -> Column:
    arr = as_col(licenses)
    known = F.filter(arr, lambda x: F.lower(strip(x)).isin(*rules.PERMISSIVE_LICENSES))
    first = F.lower(strip(F.get(known, F.lit(0))))
    return F.when(arr.isNull() | (F.size(arr) == 0), F.lit("unknown")).otherwise(F.coalesce(first, F.lit("other")))


def best_path(*paths: Column | str) -> Column:
    return F.coalesce(*[F.nullif(strip(p), F.lit("")) for p in paths], F.lit(""))


def k8s_ok(content: Column | str, api_version: bool = True, kind: bool = True, metadata: bool = True) -> Column:
    c, ok = as_col(content), F.lit(True)
    for wanted, needle in ((api_version, "apiVersion"), (kind, "kind:"), (metadata, "metadata:")):
        if wanted:
            ok = ok & c.contains(needle)
    return ok


def has_keyword(low: Column | str, groups: Sequence[str] = tuple(rules.CODE_KEYWORDS)) -> Column:
    """True when a keyword of the groups occurs in a lower-case text."""
    return keyword_any(as_col(low), [k for g in groups for k in rules.CODE_KEYWORDS[g]])


def redact(content: Column | str) -> Column:
    """Addresses, keys, mails and credential pairs replaced, in this order. The guards skip
    the expensive patterns for texts that can not match."""
    c = as_col(content)
    c = F.when(c.rlike(r"(?U)\d\.\d"), F.regexp_replace(c, "(?U)" + rules.PII_IPV4, rules.REDACTED_IPV4)).otherwise(c)
    c = F.when(c.contains("sk-"), F.regexp_replace(c, rules.PII_API_KEY, rules.REDACTED_API_KEY)).otherwise(c)
    c = F.when(c.contains("@"), F.regexp_replace(c, "(?U)" + rules.PII_EMAIL, rules.REDACTED_EMAIL)).otherwise(c)
    return F.regexp_replace(c, "(?iuU)" + rules.PII_CREDS, rules.REDACTED_CREDS)


def pii_found(content: Column | str) -> dict[str, Column]:
    """One condition per redaction pattern; credentials are matched in lower case only."""
    c = as_col(content)
    return {
        "ipv4": c.rlike("(?U)" + rules.PII_IPV4),
        "api_key": c.contains("sk-") & c.rlike(rules.PII_API_KEY),
        "email": c.contains("@") & c.rlike("(?U)" + rules.PII_EMAIL),
        "creds": c.rlike("(?U)" + rules.PII_CREDS),
    }


def has_pii(content: Column | str) -> Column:
    hits = list(pii_found(content).values())
    return hits[0] | hits[1] | hits[2] | hits[3]


def pii_leaks(content: Column | str) -> Column:
    """Names of the looser leak patterns that still match the output."""
    return F.array_compact(F.array(*[F.when(hit, F.lit(n)) for n, hit in leaks_found(content).items()]))


def leaks_found(content: Column | str) -> dict[str, Column]:
    """One condition per leak pattern, in their order. The mail pattern as it is written would be tried again from
    every character of a word, so a long word takes time by the square of its length."""
    c = as_col(content)
    return {n: c.contains(literal) & c.rlike("(?U)" + p) for n, (literal, p) in rules.LEAK_TESTS.items()}


def prompt_slug(path: Column | str) -> Column:
    p = F.coalesce(F.nullif(as_col(path), F.lit("")), F.lit("manifest.yaml"))
    name = F.regexp_replace(F.substring_index(p, "/", -1), r"(?i)\.(yaml|yml)$", "")
    return strip(F.regexp_replace(name, "[-_]+", " "))


def synthesize_prompt(path: Column | str) -> Column:
    """An instruction from the file name: first rule whose word occurs in it."""
    return prompt_of_slug(prompt_slug(path))


def prompt_of_slug(slug: Column | str) -> Column:
    """The same from a slug that already is a column, so that the rules do not repeat its patterns."""
    slug = as_col(slug)
    low = F.lower(slug)

    def fill(template: str) -> Column:
        return F.replace(F.lit(template), F.lit("{slug}"), slug)

    return first_match([(low.contains(m), fill(t)) for m, t in rules.PROMPT_RULES], fill(rules.PROMPT_FALLBACK))


def wrap_tool_call(content: Column | str) -> Column:
    return F.concat(F.lit('{"tool": "apply_manifest", "params": {"manifest_content": '),
                    json_text(content), F.lit("}}"))


@F.arrow_udf(T.BooleanType())
def _yaml_loads(texts: pa.Array) -> pa.Array:
    import yaml

    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

    def ok(text):
        if text is None:
            return None
        try:
            yaml.load(text, Loader=loader)
            return True
        except Exception:  # bad dates and the like leave the loader as other error types
            return False

    # one text at a time, so that a worker never holds a batch both as Arrow and as Python strings
    return pa.array((ok(t.as_py()) for t in texts), pa.bool_(), size=len(texts))


# keeps the optimizer from moving the call into a filter and so running it twice per row
_yaml_loads = _yaml_loads.asNondeterministic()


def yaml_valid(content: Column | str, only_where: Column | None = None) -> Column:
    """Single-document YAML that loads; null where ``only_where`` is false, so closed rows
    cross to Python as nulls and are not parsed."""
    c = as_col(content)
    return _yaml_loads(c if only_where is None else F.when(only_where, c))
