"""Telemetry tokens and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions.core import as_col, first_match, lookup

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def bin_token(col: Column | str, base: int) -> Column:
    """Ten-wide bins of text: base + min(floor(v / 10), 9). Text that is no number, null, NaN
    and infinities give base + 4; negatives run below the base on purpose."""
    text = as_col(col).cast("string")
    return numeric_bin_token(F.when(text.rlike(_NUMBER), text.try_cast("double")), base)


def numeric_bin_token(col: Column | str, base: int) -> Column:
    """``bin_token`` for a column that already is numeric: no text round trip."""
    value = as_col(col).cast("double")
    bin_index = F.floor(F.least(value / 10, F.lit(float(rules.BIN_MAX)))).cast("int")
    # least skips nulls, so the missing values are told apart by the finite test
    finite = ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    return F.when(finite, bin_index + base).otherwise(F.lit(base + rules.BIN_DEFAULT))


def cpu_token(col: Column | str) -> Column:
    return numeric_bin_token(col, rules.CPU_BASE)


def mem_token(col: Column | str) -> Column:
    return numeric_bin_token(col, rules.MEM_BASE)


def planned_mem_token(plan_mem: Column | str) -> Column:
    """Planned memory is a 0..1 share; a missing plan counts as 0, not as unknown."""
    return mem_token(F.coalesce(as_col(plan_mem) * 100, F.lit(0.0)))


def status_token(col: Column | str) -> Column:
    return lookup(as_col(col), rules.STATUS_TOKENS, rules.STATUS_DEFAULT)


def event_token(col: Column | str) -> Column:
    return lookup(F.lower(as_col(col)), rules.EVENT_TOKENS, rules.EVENT_DEFAULT)


def job_label(status: Column, cpu_tok: Column, mem_tok: Column) -> Column:
    return first_match(
        [
            ((status == "Failed") & (cpu_tok <= 103), 2),
            ((status == "Terminated") & (mem_tok >= 207), 1),
            (status.isin("Failed", "Waiting"), 4),
        ],
        0,
    )


def usage_label(last_cpu: Column, last_mem: Column) -> Column:
    """Resource exhaustion from the last sample. The CPU rule can not fire on CPU tokens
    (they end at 109); it is kept because the label contract has it."""
    return F.when((last_mem >= 207) | (last_cpu >= 208), F.lit(1)).otherwise(F.lit(0))


def label_name(label: Column | str) -> Column:
    return lookup(as_col(label), rules.LABEL_NAMES)
