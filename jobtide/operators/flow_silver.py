"""Monthly rows: typed columns, validity flags, routing to scope and reject tables.

One pass handles any number of months and kinds: ``file_kind`` and ``ingest_competence`` travel with the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import EFFECTIVE_MONTH_COLUMNS, OCCUPATION_FAMILIES, STATE_BY_CODE
from jobtide.functions.codes import is_known_state, label_or_code, occupation_family
from jobtide.functions.movement import adjustment_factor, delta_columns, month_text, movement_label
from jobtide.functions.numbers import brazilian_number, lenient_smallint
from jobtide.functions.text import digits_only
from jobtide.operators.joins import evaluate_once

FLAGS = ["erro_uf", "erro_cbo", "erro_saldo", "erro_salario"]


@dataclass(frozen=True)
class RoutedFlow:
    """``scope``: valid rows of the wanted occupation families. ``rejected``: invalid rows of every family."""

    scope: DataFrame
    valid: DataFrame
    rejected: DataFrame


def typed_flow(rows: DataFrame, labels: Mapping[str, str] = STATE_BY_CODE) -> DataFrame:
    """Cleaned codes, numbers, state label, family and movement label. Other columns pass through."""
    cleaned = rows.withColumns(
        {
            "uf_codigo": F.trim("uf_codigo"),
            "cbo_codigo": digits_only(F.col("cbo_codigo")),
            "municipio_codigo_caged": digits_only(F.col("municipio_codigo_caged")),
            "saldo_movimentacao": lenient_smallint(F.col("saldo_movimentacao")),
            "tipo_movimentacao": lenient_smallint(digits_only(F.col("tipo_movimentacao"))),
            "salario_mensal": brazilian_number(F.col("salario_mensal")),
        }
    )
    return cleaned.withColumns(
        {
            "uf": label_or_code(F.col("uf_codigo"), labels),
            "cbo_familia": occupation_family(F.col("cbo_codigo")),
            "movimento": movement_label(F.col("saldo_movimentacao")),
        }
    )


def validity_flags(labels: Mapping[str, str] = STATE_BY_CODE, null_flags: str = "reject") -> dict[str, Column]:
    """Error flags of a typed row.

    A null state or sign makes its flag null. ``null_flags='reject'`` counts that as an error, so every row is either
    valid or rejected. ``null_flags='reference'`` keeps the null, and such a row is in neither table.
    """
    if null_flags not in ("reject", "reference"):
        raise ValueError("null_flags must be 'reject' or 'reference'")
    unknown = F.lit(True) if null_flags == "reject" else F.lit(None).cast("boolean")
    code, salary = F.col("cbo_codigo"), F.col("salario_mensal")
    return {
        "erro_uf": F.coalesce(~is_known_state(F.col("uf"), labels), unknown),
        "erro_cbo": F.coalesce(F.length(code) < 4, F.lit(True)),
        "erro_saldo": F.coalesce(~F.col("saldo_movimentacao").isin(-1, 1), unknown),
        "erro_salario": F.coalesce(salary < 0, F.lit(False)),
    }


def effective_month_by_kind(columns: list[str]) -> Column:
    """:func:`effective_month` for rows of mixed kinds. Base rows belong to the month they were ingested for."""
    candidates = dict.fromkeys(name for names in EFFECTIVE_MONTH_COLUMNS.values() for name in names)
    months = [
        F.when(
            F.col("file_kind").isin([k for k, names in EFFECTIVE_MONTH_COLUMNS.items() if name in names]),
            month_text(F.col(name)),
        )
        for name in candidates
        if name in columns
    ]
    return F.coalesce(*months, F.col("ingest_competence"))


def flow_silver(
    rows: DataFrame, labels: Mapping[str, str] = STATE_BY_CODE, null_flags: str = "reject"
) -> DataFrame:
    """All rows, typed and flagged, with deltas, effective month and kind.

    Reports aggregate this frame directly and prune what they do not read; :func:`route_flow` splits it.
    """
    typed = typed_flow(rows, labels)
    flagged = typed.withColumns(validity_flags(labels, null_flags))
    invalid = F.col(FLAGS[0]) | F.col(FLAGS[1]) | F.col(FLAGS[2]) | F.col(FLAGS[3])
    deltas = delta_columns(F.col("saldo_movimentacao"), adjustment_factor(F.col("file_kind")))
    return flagged.withColumns(
        {
            "registro_invalido": invalid,
            "effective_competence": effective_month_by_kind(rows.columns),
            **deltas,
            "adjustment_kind": F.col("file_kind"),
        }
    )


def route_flow(
    silver: DataFrame, families: Iterable[str] = tuple(OCCUPATION_FAMILIES), stored: bool = False
) -> RoutedFlow:
    """Split flagged rows. The three frames are filters over one frame: a pipeline stores that frame first, and the
    filters then prune the table instead of parsing the text three times. ``stored`` says that ``silver`` is such a
    table: its filters go down to the scan."""
    rows = silver if stored else evaluate_once(silver)
    valid = rows.where(~F.col("registro_invalido"))
    return RoutedFlow(
        scope=valid.where(F.col("cbo_familia").isin(sorted(families))),
        valid=valid,
        rejected=rows.where(F.col("registro_invalido")),
    )
