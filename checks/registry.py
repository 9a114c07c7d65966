"""Collects queries with their oracle SQL; an oracle names the views it needs by using them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import VIEWS, Dialect

DUCK = Dialect("duck")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SQL_VIEWS: dict[str, str] = {name: sql(DUCK) for name, (_, sql) in VIEWS.items()}


def sql_view(name: str, sql: str) -> None:
    SQL_VIEWS[name] = sql


def _needs(sql: str, seen: list[str]) -> list[str]:
    for name in SQL_VIEWS:
        if name not in seen and re.search(rf"(?:\b(?:from|join)\s+|, ){name}\b", sql):
            _needs(SQL_VIEWS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def oracle(sql: str) -> str:
    names = _needs(sql, [])
    if not names:
        return sql
    # a view that several others read is computed once
    ctes = ",\n".join(f"{n} as materialized ({SQL_VIEWS[n]})" for n in names)
    joiner = ",\n" if sql.lstrip().lower().startswith("with ") else "\n"
    return f"with {ctes}{joiner}{sql.lstrip()[5:] if joiner.startswith(',') else sql}"


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn
    return register


# --- SQL snippets ------------------------------------------------------------


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def kw(expr: str, words) -> str:
    return "(" + " or ".join(f"contains({expr}, {lit(w)})" for w in words) + ")"


def in_list(words) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"


def case_map(expr: str, mapping, default: str) -> str:
    whens = " ".join(f"when {lit(k) if isinstance(k, str) else k} then {lit(v) if isinstance(v, str) else v}"
                     for k, v in mapping.items())
    return f"case {expr} {whens} else {default} end"


def py_round(expr: str, digits: int) -> str:
    """Half to even on the exact binary value, by exact decimal text of the double."""
    t, u = 10 ** (digits + 1), 10 ** digits
    return (f"(select case when d % 10 = 5 then (case when r > 0 then b + 1 when r < 0 then b else b + (b % 2) end) "
            f"else w * {u} + floor((d + 5) / 10) end / {u}::double from (select *, w * {u} + (d - 5) / 10 as b, "
            f"(h * {t} - d) + (f - h) * {t} as r from (select *, (f * 134217729::double) - ((f * 134217729::double) - f) as h, "
            f"floor(f * {t} + 0.5::double) as d from (select *, v - w as f from (select v, floor(v) as w from (select ({expr})::double as v))))))")


def np_round(expr: str, digits: int) -> str:
    u = 10 ** digits
    y = f"(({expr}) * {u}::double)"
    return f"((case when {y} - floor({y}) = 0.5 then 2 * round({y} / 2) else round({y}) end) / {u}::double)"
