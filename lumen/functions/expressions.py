"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Spark 4 runs with ANSI semantics: an unguarded division by zero raises, so
every ratio here goes through ``try_divide`` (NULL on a zero denominator).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or NULL."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def pct(num: str | Column, den: str | Column) -> Column:
    """``100.0 * num / den`` as double (multiplied first, as SQL writes it),
    NULL on a zero denominator."""
    return F.try_divide(F.lit(100.0) * col_of(num).cast("double"), col_of(den).cast("double"))


def pct_change(cur: str | Column, prev: str | Column) -> Column:
    """Percent change from ``prev`` to ``cur``; NULL when ``prev`` is 0 or NULL."""
    return pct(col_of(cur) - col_of(prev), F.nullif(col_of(prev), F.lit(0)))


def count_where(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)`` — rows where ``pred`` holds."""
    return F.count_if(pred)


def rate_where(pred: Column) -> Column:
    """Percent of rows where ``pred`` holds (``100.0 * SUM(CASE) / COUNT(*)``)."""
    return pct(F.count_if(pred), F.count(F.lit(1)))


def case_when(branches: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """``CASE WHEN c1 THEN v1 ... ELSE otherwise END``."""
    expr = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if otherwise is not None:
        expr = expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return expr


def level_position(c: str | Column, levels: Sequence[str]) -> Column:
    """1-based position of ``c`` in an ordered level list; NULL if absent.

    Sorting on it (NULLs last) orders categories the way an ordered
    categorical does.
    """
    arr = F.array(*[F.lit(v) for v in levels])
    return F.nullif(F.array_position(arr, col_of(c)).cast("int"), F.lit(0))


def round_half_up(c: str | Column, scale: int = 2) -> Column:
    """HALF_UP rounding (Spark's ``round``)."""
    return F.round(col_of(c), scale)


def first_column(df) -> Column:
    """The first column whatever its name (an unnamed CSV index column)."""
    return F.col(df.columns[0])
