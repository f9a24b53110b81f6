"""Occupation, municipality and state codes."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.fixed_values import (
    RESIDUAL_MUNICIPALITY,
    STATE_BY_CODE,
    STATE_BY_MUNICIPALITY_PREFIX,
    UNIDENTIFIED_STATE,
)
from jobtide.functions.text import digits_only


def literal_map(values: Mapping[str, object]) -> Column:
    """A configuration table as a map literal: constant-folded, no join."""
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(values.items())])


def label_or_code(col: Column, labels: Mapping[str, str] = STATE_BY_CODE) -> Column:
    """Label of a code; a code without label passes through as itself."""
    return F.coalesce(F.try_element_at(literal_map(labels), col), col)


def occupation_family(code: Column) -> Column:
    return F.substring(code, 1, 4)


def occupation_code(raw: Column) -> Column:
    """Six-digit code. A five-digit code lost its leading zero; any other length is null."""
    digits = digits_only(raw)
    return F.when(F.length(digits) == 5, F.concat(F.lit("0"), digits)).when(F.length(digits) == 6, digits)


def occupation_code_from_cell(kind: Column, text: Column) -> Column:
    """Six-character code from a spreadsheet cell given as (kind, text).

    ``kind`` is one of ``int``, ``float``, ``bool``, ``text``. A whole float counts as an integer, text keeps
    its digits, booleans and blanks are null.
    """
    whole = F.when(text.try_cast("double") == F.floor(text.try_cast("double")), text.try_cast("double").cast("bigint"))
    value = (
        F.when(kind == "int", text)
        .when(kind == "float", whole.cast("string"))
        .when(kind == "text", digits_only(text))
    )
    return F.when(F.length(value) == 6, value)


def municipality_code(raw: Column) -> Column:
    """Six-digit code; the seventh (check) digit is dropped; any other length is null."""
    digits = digits_only(raw)
    return F.when(F.length(digits).isin(6, 7), F.substring(digits, 1, 6))


def state_of_municipality(code: Column) -> Column:
    """State of a six-digit municipality code; null for an unknown prefix."""
    by_prefix = F.try_element_at(literal_map(STATE_BY_MUNICIPALITY_PREFIX), F.substring(code, 1, 2))
    return F.when(code == RESIDUAL_MUNICIPALITY, F.lit(UNIDENTIFIED_STATE)).when(F.length(code) == 6, by_prefix)


def is_known_state(col: Column, labels: Mapping[str, str] = STATE_BY_CODE) -> Column:
    return col.isin(sorted(set(labels.values())))


def row_predicates(state: Column, code: Column, salary: Column) -> dict[str, Column]:
    """Stand-alone row rules. Unlike the flow flags these never return null: a missing state or code fails."""
    states = sorted(set(STATE_BY_MUNICIPALITY_PREFIX.values()))
    return {
        "valid_uf": F.coalesce(state.isin(states), F.lit(False)),
        "valid_cbo": F.coalesce(code.rlike(r"^\d{4,}$"), F.lit(False)),
        "valid_salary": F.coalesce(salary >= 0, F.lit(True)),
    }
