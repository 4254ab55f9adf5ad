"""Left joins that keep their parallelism when the join key has few or hot values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Sequence[str], slices: int = 32
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING ``on``, with each key split over ``slices`` tasks.

    For keys such as a year, where a shuffle on the key alone would leave all work to a handful of tasks. Left
    rows take a slice from a hash of ``spread_by``; right rows are repeated once per slice, so every match is
    found exactly once. Below the broadcast threshold Spark drops the shuffle and the slices cost nothing.
    """
    sliced = left.withColumn("_slice", F.pmod(F.xxhash64(*spread_by), F.lit(slices)).cast("int"))
    repeated = right.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return sliced.join(repeated, [*on, "_slice"], "left").drop("_slice")


def null_safe_left_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left`` LEFT JOIN ``right`` where NULL keys match each other; columns of ``left``, then the rest of ``right``."""
    renamed = right.withColumnsRenamed({name: f"_r_{name}" for name in on})
    match = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_r_{name}")) for name in on])
    return left.join(renamed, match, "left").drop(*[f"_r_{name}" for name in on])
