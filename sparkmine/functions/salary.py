"""Salary cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmine.functions.text import strip_commas

# Payments per year by pay period, and the spelling of "missing".
PAY_PERIODS = {"Monthly": 12, "Weekly": 52}
MISSING = "NA"
INT_MIN, INT_MAX = -2147483648, 2147483647


def has_salary(salary: str = "salary") -> Column:
    """True when a salary was given: neither zero nor the missing mark. A null
    salary gives null, so a filter drops it."""
    return (strip_commas(salary) != "0") & (F.col(salary) != MISSING)


def annual_factor(salary_type: str, factors: dict[str, int], default: int) -> Column:
    kind = F.col(salary_type)
    expr = None
    for period, times in factors.items():
        expr = (expr.when if expr is not None else F.when)(kind == period, F.lit(times))
    other = kind.isNotNull()
    return expr.when(other, F.lit(default)) if expr is not None else F.when(other, F.lit(default))


def salary_number(salary: str = "salary") -> Column:
    """The salary as a number; text that is not a number becomes null."""
    return strip_commas(salary).try_cast("double")


def saturated_int(c: str) -> Column:
    """Whole part, held inside the 32-bit range."""
    return F.least(F.greatest(F.col(c), F.lit(float(INT_MIN))), F.lit(float(INT_MAX))).cast("int")


def two_decimals(c: str) -> Column:
    return F.round(F.col(c), 2)
