"""Value of the previous available period, and the change since then."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estrato.functions.measures import gap
from estrato.operators.joins import null_safe_left_join


def evolution(
    df: DataFrame,
    value: str,
    partition: Sequence[str],
    period: str,
    tiebreak: Sequence[str],
    previous: str = "previous",
    change: str = "change",
    digits: int = 2,
) -> DataFrame:
    """Add ``previous`` (the row before, ordered by ``period`` then ``tiebreak``) and ``change``.

    "Previous" is the previous row that exists, not the previous calendar period. Work is split by
    (partition, period): inside a period a window looks one row back, and the first row of a period takes the
    last value of the period before it from a table with one row per (partition, period). A partition with a
    large share of the rows is thus spread over its periods. ``df`` is read twice: pass a stored table.
    """
    last_of_period = df.groupBy(*partition, period).agg(
        F.max_by(value, F.struct(*tiebreak)).alias("_last")
    )
    periods = Window.partitionBy(*partition).orderBy(F.col(period).asc_nulls_last())
    carried = last_of_period.select(*partition, period, F.lag("_last").over(periods).alias("_carried"))

    inside = Window.partitionBy(*partition, period).orderBy(*[F.col(t).asc_nulls_first() for t in tiebreak])
    stepped = df.withColumns(
        {"_place": F.row_number().over(inside), "_before": F.lag(value).over(inside)}
    )
    joined = null_safe_left_join(stepped, carried, [*partition, period])
    before = F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col("_before"))
    return (
        joined.withColumn(previous, before)
        .withColumn(change, gap(F.col(value), F.col(previous), digits))
        .drop("_place", "_before", "_carried")
    )
