"""Boolean quality rules. Every rule is true or false, never NULL; missing input is false unless stated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _certain(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def filled(name: str) -> Column:
    return F.col(name).isNotNull()


def any_filled(names: Sequence[str]) -> Column:
    return F.coalesce(*names).isNotNull()


def length_is(name: str, size: int) -> Column:
    return _certain(F.length(name) == size)


def in_range(name: str, low: float, high: float) -> Column:
    # NaN sorts above every number in Spark, so the upper bound already excludes it.
    return _certain(F.col(name).between(low, high))


def all_in_range(names: Sequence[str], low: float, high: float) -> Column:
    rule = F.lit(True)
    for name in names:
        rule = rule & F.col(name).between(low, high)
    return _certain(rule)


def in_set(name: str, values: Sequence[object]) -> Column:
    return _certain(F.col(name).isin(*values))


def equals(name: str, value: object) -> Column:
    return _certain(F.col(name) == F.lit(value))


def null_or_at_least(name: str, low: float) -> Column:
    """True for a missing value and for one that reaches ``low``; NaN reaches nothing."""
    return F.col(name).isNull() | _certain((F.col(name) >= low) & ~F.isnan(name))


def below(name: str, bound: float) -> Column:
    return _certain(F.col(name) < bound)


def is_false(name: str) -> Column:
    return _certain(~F.col(name))
