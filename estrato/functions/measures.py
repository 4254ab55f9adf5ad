"""Numbers and labels derived from indicator columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_COUNT = "decimal(20,0)"


def business_key(*names: str, sep: str = "_") -> Column:
    """The parts joined by ``sep``; NULL as soon as one part is NULL."""
    parts: list[Column] = []
    for name in names:
        if parts:
            parts.append(F.lit(sep))
        parts.append(F.col(name).cast("string"))
    return F.concat(*parts)


def pct(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` of two counts, rounded in decimal arithmetic; NULL unless ``whole`` is positive."""
    ratio = F.lit(100).cast("decimal(3,0)") * part.cast(_COUNT) / whole.cast(_COUNT)
    return F.when(whole > 0, F.round(ratio, digits).cast("double"))


def gap(value: Column, goal: Column, digits: int = 2) -> Column:
    """``value - goal``, both taken as the decimals they are written as, rounded half up."""
    exact = lambda number: number.try_cast("decimal(24,9)")
    return F.round(exact(value) - exact(goal), digits).cast("double")


def target_for_year(year: str, columns: Mapping[int, str]) -> Column:
    """The target column that belongs to the row's year; NULL for a year without one."""
    branches = iter(columns.items())
    first_year, first = next(branches)
    chosen = F.when(F.col(year) == first_year, F.col(first))
    for target_year, name in branches:
        chosen = chosen.when(F.col(year) == target_year, F.col(name))
    return chosen


def against_target(value: Column, target: Column, reached: str, missed: str) -> Column:
    """``reached`` when the value reaches the target; ``missed`` otherwise, also when there is no target."""
    return F.when(value >= target, F.lit(reached)).otherwise(F.lit(missed))


def bucketize(value: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` for the first bound the value lies below, the last label otherwise."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("bucketize needs one label more than bounds")
    chosen = F.when(value < bounds[0], F.lit(labels[0]))
    for bound, label in zip(bounds[1:], labels[1:]):
        chosen = chosen.when(value < bound, F.lit(label))
    return chosen.otherwise(F.lit(labels[-1]))
