"""Shape check of generated workflow documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions.core import as_col, json_valid

# text and numbers that a lenient integer field takes
_INTEGER_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"


def _kind(doc: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(doc), path, "variant"))


def _whole_number(doc: Column, path: str) -> Column:
    kind, text = _kind(doc, path), F.get_json_object(doc, path)
    integral = text.try_cast("double") == F.floor(text.try_cast("double"))
    return (
        kind.isin("BIGINT", "BOOLEAN")
        | ((kind.startswith("DECIMAL") | (kind == "DOUBLE")) & integral)
        | ((kind == "STRING") & text.rlike(_INTEGER_TEXT))
    )


def valid_workflow(col: Column | str) -> Column:
    """``{"steps": [{"step_id": int, "tool": str, "params": {...}}]}`` where params hold only
    the known optional keys. Whole numbers may be written as text, as lenient models take them."""
    text = as_col(col)
    steps = F.from_json(F.get_json_object(text, "$.steps"), "array<string>")
    known = F.array(*[F.lit(k) for k in rules.STEP_PARAM_KEYS])

    def optional(found: Column, ok: Column) -> Column:
        return found.isNull() | (found == "VOID") | ok

    def step_ok(s: Column) -> Column:
        params = F.get_json_object(s, "$.params")
        deployment, replicas, pod = (_kind(s, f"$.params.{k}") for k in rules.STEP_PARAM_KEYS)
        return (
            _whole_number(s, "$.step_id")
            & (_kind(s, "$.tool") == "STRING")
            & params.startswith("{")
            & (F.size(F.array_except(F.json_object_keys(params), known)) == 0)
            & optional(deployment, deployment == "STRING")
            & optional(replicas, _whole_number(s, "$.params.replicas"))
            & optional(pod, pod == "STRING")
        )

    shaped = F.get_json_object(text, "$.steps").startswith("[")
    every = F.forall(steps, lambda s: F.coalesce(step_ok(s), F.lit(False)))
    return F.coalesce(json_valid(text) & shaped & every, F.lit(False))
