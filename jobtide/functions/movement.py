"""Movement sign, adjustment deltas and the month an adjustment belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import ADJUSTMENT_FACTOR, EFFECTIVE_MONTH_COLUMNS, MOVEMENT_LABELS
from jobtide.functions.text import digits_only

DELTAS = ["admissions_delta", "dismissals_delta", "balance_delta"]


def movement_label(sign: Column) -> Column:
    label = F.lit(None).cast("string")
    for value, text in MOVEMENT_LABELS.items():
        label = F.when(sign == value, F.lit(text)).otherwise(label)
    return label


def checked_kind(kind: str) -> str:
    value = kind.strip().upper()
    if value not in ADJUSTMENT_FACTOR:
        raise ValueError(f"adjustment kind must be one of {sorted(ADJUSTMENT_FACTOR)}, got {kind!r}")
    return value


def adjustment_factor(kind: Column) -> Column:
    """-1 for a retraction, +1 otherwise."""
    return F.when(kind == "EXC", F.lit(ADJUSTMENT_FACTOR["EXC"])).otherwise(F.lit(1))


def delta_columns(sign: Column, factor: Column) -> dict[str, Column]:
    """Effect of a row on hires, terminations and balance. A retraction cancels; it never becomes the other movement."""
    return {
        "admissions_delta": F.when(sign == 1, factor).otherwise(F.lit(0)).cast("smallint"),
        "dismissals_delta": F.when(sign == -1, factor).otherwise(F.lit(0)).cast("smallint"),
        "balance_delta": (sign * factor).cast("smallint"),
    }


def with_adjustment_deltas(df: DataFrame, kind: str) -> DataFrame:
    kind = checked_kind(kind)
    deltas = delta_columns(F.col("saldo_movimentacao"), F.lit(ADJUSTMENT_FACTOR[kind]))
    return df.withColumns({**deltas, "adjustment_kind": F.lit(kind)})


def with_base_deltas(df: DataFrame, month: str | Column) -> DataFrame:
    """Deltas of base (MOV) rows. Only columns that are absent are added."""
    sign = F.col("saldo_movimentacao")
    defaults = {
        "admissions_delta": (sign == 1).cast("smallint"),
        "dismissals_delta": (sign == -1).cast("smallint"),
        "balance_delta": sign.cast("smallint"),
        "effective_competence": month if isinstance(month, Column) else F.lit(month),
        "adjustment_kind": F.lit("MOV"),
    }
    return df.withColumns({name: expr for name, expr in defaults.items() if name not in df.columns})


def month_text(col: Column) -> Column:
    """First six digits of a text, null when it has none."""
    return F.nullif(F.substring(digits_only(col.cast("string")), 1, 6), F.lit(""))


def effective_month(columns: list[str], kind: str, ingest_month: str | Column) -> Column:
    """Month an adjustment changes: the first candidate column that has digits, else the month it was ingested."""
    fallback = ingest_month if isinstance(ingest_month, Column) else F.lit(ingest_month)
    present = [month_text(F.col(name)) for name in EFFECTIVE_MONTH_COLUMNS[kind] if name in columns]
    return F.coalesce(*present, fallback)
