"""Text cleaning and Q&A features."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain import rules
from opsgrain.functions.core import as_col, first_match, keyword_any, normalize_whitespace, word_count


def code_blocks(col: Column | str) -> Column:
    return F.regexp_extract_all(as_col(col), F.lit(rules.CODE_BLOCK), F.lit(0))


def text_without_code(col: Column | str) -> Column:
    return normalize_whitespace(F.regexp_replace(as_col(col), rules.CODE_BLOCK, " [CODE] "))


def clean_text(col: Column | str, remove_code: bool = False) -> Column:
    text = F.regexp_replace(F.coalesce(as_col(col), F.lit("")), rules.URL_PREFIX + rules.JAVA_NON_SPACE, "[URL]")
    if remove_code:
        text = F.regexp_replace(F.regexp_replace(text, r"```[\s\S]*?```", ""), r"`[^`]+`", "")
    return normalize_whitespace(text)


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


# keeps the optimizer from running the call more than once per row
_unescape = _unescape.asNondeterministic()


# fixed values: the entities of the native path, the ampersand last so nothing is decoded twice
_BASIC_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
    ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"),
)


def clean_html(col: Column | str, entities: str = "all") -> Column:
    """Tags to blanks, then entities, then white space.

    ``entities="all"`` decodes the whole HTML5 table in an Arrow UDF that only receives the
    texts still holding an ``&``; ``"basic"`` stays JVM-side with the common eight.
    """
    bare = F.regexp_replace(F.coalesce(as_col(col), F.lit("")), rules.HTML_TAG, " ")
    if entities == "all":
        decoded = F.coalesce(_unescape(F.when(bare.contains("&"), bare)), bare)
    else:
        decoded = bare
        for entity, char in _BASIC_ENTITIES:
            decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return normalize_whitespace(decoded)


def text_metrics(col: Column | str) -> Column:
    text = F.coalesce(as_col(col), F.lit(""))
    return F.struct(
        F.length(text).alias("char_count"),
        word_count(text).alias("word_count"),
        F.regexp_count(text, F.lit(rules.SENTENCE_MARKS)).alias("sentence_count"),
        F.regexp_count(text, F.lit(rules.CODE_BLOCK)).alias("code_block_count"),
    )


def _names_found(low: Column | str, table) -> Column:
    low = as_col(low)
    return F.array_compact(F.array(*[F.when(keyword_any(low, kws), F.lit(name)) for name, kws in table]))


def error_signatures(low: Column | str) -> Column:
    """Names of the error patterns found in a lower-case text, in fixed order."""
    return _names_found(low, rules.ERROR_SIGNATURES)


def infra_components(low: Column | str) -> Column:
    """Names of the infrastructure components found in a lower-case text."""
    return _names_found(low, rules.INFRA_COMPONENTS)


def text_complexity(col: Column | str) -> Column:
    text = F.coalesce(as_col(col), F.lit(""))
    words, blocks = word_count(text), F.regexp_count(text, F.lit(rules.CODE_BLOCK))
    return first_match(
        [((words < 50) & (blocks == 0), "simple"), ((words < 200) | (blocks <= 1), "moderate")], "complex"
    )


def question_type(low: Column | str) -> Column:
    """First matching rule over a lower-case question."""
    low = as_col(low)
    return first_match([(low.rlike(p), name) for name, p in rules.QUESTION_TYPE_RULES], "general")


def quality_points(score, answer_score, view_count, question_body, answer_body) -> Column:
    """Votes, views and capped length terms; bodies are the uncleaned ones. The score is this
    value rounded to two decimals with ``py_round``."""
    s, a, v = (F.coalesce(as_col(c), F.lit(0)) for c in (score, answer_score, view_count))
    q, ans = (F.coalesce(as_col(c), F.lit("")) for c in (question_body, answer_body))
    return (
        s * F.lit(2.0) + a * F.lit(3.0) + v * F.lit(0.001)
        + F.least(word_count(q) / F.lit(50.0), F.lit(2.0))
        + F.least(word_count(ans) / F.lit(100.0), F.lit(3.0))
        + F.regexp_count(ans, F.lit(rules.CODE_BLOCK)) * F.lit(0.5)
    )
