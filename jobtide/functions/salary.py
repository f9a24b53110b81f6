"""Which hires count for salary statistics."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.errors import LayoutError
from jobtide.fixed_values import (
    INTERMITTENT_WORDS,
    MINIMUM_WAGE_BY_YEAR,
    SALARY_MAXIMUM_MULTIPLE,
    SALARY_MINIMUM_MULTIPLE,
)
from jobtide.functions.codes import literal_map

REQUIRED_COLUMNS = ["saldo_movimentacao", "salario_mensal", "indicador_trabalho_intermitente"]
ELIGIBLE = "salario_admissao_elegivel"


@dataclass(frozen=True)
class SalaryRule:
    """Closed salary bounds per year as multiples of that year's minimum wage."""

    minimum_wage: Mapping[int, float] = field(default_factory=lambda: dict(MINIMUM_WAGE_BY_YEAR))
    minimum_multiple: float = SALARY_MINIMUM_MULTIPLE
    maximum_multiple: float = SALARY_MAXIMUM_MULTIPLE

    def bounds(self, month: str) -> tuple[float, float]:
        if len(month) != 6 or not month.isdigit():
            raise ValueError(f"month must be YYYYMM, got {month!r}")
        wage = self.minimum_wage.get(int(month[:4]))
        if wage is None:
            raise ValueError(f"no minimum wage is configured for {month[:4]}")
        return round(wage * self.minimum_multiple, 2), round(wage * self.maximum_multiple, 2)

    def bound_columns(self, month: Column) -> tuple[Column, Column]:
        """Bounds for a month column. A year without a minimum wage fails the job rather than passing silently."""
        years = {str(year): self.bounds(f"{year}01") for year in self.minimum_wage}
        year = F.substring(month, 1, 4)
        unknown = F.raise_error(F.concat(F.lit("no minimum wage is configured for "), year)).cast("double")
        low = F.coalesce(F.try_element_at(literal_map({y: b[0] for y, b in years.items()}), year), unknown)
        high = F.coalesce(F.try_element_at(literal_map({y: b[1] for y, b in years.items()}), year), unknown)
        return low, high


def salary_eligible(sign: Column, salary: Column, intermittent: Column, low: Column, high: Column) -> Column:
    """Three-valued on purpose: a missing intermittent mark gives null, and a filter then leaves the row out."""
    is_intermittent = F.lower(F.trim(intermittent.cast("string"))).isin(INTERMITTENT_WORDS)
    return (sign == 1) & salary.isNotNull() & salary.between(low, high) & ~is_intermittent


def with_salary_eligibility(df: DataFrame, rule: SalaryRule, month: str | Column) -> DataFrame:
    missing = [name for name in REQUIRED_COLUMNS if name not in df.columns]
    if missing:
        raise LayoutError("salary rule needs missing columns: " + ", ".join(sorted(missing)))
    low, high = rule.bound_columns(month) if isinstance(month, Column) else map(F.lit, rule.bounds(month))
    return df.withColumn(
        ELIGIBLE,
        salary_eligible(
            F.col("saldo_movimentacao"),
            F.col("salario_mensal"),
            F.col("indicador_trabalho_intermitente"),
            low,
            high,
        ),
    )
