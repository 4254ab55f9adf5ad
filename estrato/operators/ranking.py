"""SQL RANK inside coarse groups without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from estrato.operators.joins import null_safe_left_join
from estrato.session import stage

_SLICES = 32


def rank_within(
    df: DataFrame,
    partition: Sequence[str],
    value: str,
    output: str = "rank",
    weight: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add RANK() OVER (PARTITION BY ``partition`` ORDER BY ``value`` DESC NULLS LAST): equal values share a rank.

    A value's rank is one more than the number of rows with a greater value; with ``weight`` each row stands for
    that many rows. Rows are first counted per distinct value (map-side, so a value shared by a third of the rows
    is one row after the shuffle). Distinct values are then dealt into ranges whose bounds Spark samples from the
    data, so a range holds as much of a group as of any other; counts run inside each range, and the sizes of
    higher ranges of the group are added from a table with one row per group and range. The ranges are written to
    the shared folder, which fixes them for both uses. Ranks reach the rows by a join that is split into slices of
    a hash of the row, so rows that share a value do not meet in one task.

    The counts read ``counted`` if given, else ``df`` a second time: pass a stored table for either.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    tallies = (df if counted is None else counted).groupBy(*partition, value).agg(rows.alias("_rows"))
    bounds = [*[F.col(name) for name in partition], F.col(value).desc_nulls_last()]
    ranged = stage(tallies.repartitionByRange(*bounds).withColumn("_range", F.spark_partition_id()), "rank")

    ranges = Window.partitionBy(*partition).orderBy("_range")
    sizes = ranged.groupBy(*partition, "_range").agg(F.sum("_rows").alias("_size"))
    higher = sizes.select(*partition, "_range", _running_before("_size", ranges).alias("_higher"))
    inside = Window.partitionBy(*partition, "_range").orderBy(F.col(value).desc_nulls_last())
    ahead = ranged.withColumn("_ahead", _running_before("_rows", inside))
    ranks = null_safe_left_join(ahead, higher, [*partition, "_range"]).select(
        *partition,
        value,
        (F.col("_higher") + F.col("_ahead") + 1).alias(output),
        F.explode(F.sequence(F.lit(0), F.lit(_SLICES - 1))).alias("_slice"),
    )
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(_SLICES)).cast("int"))
    return null_safe_left_join(sliced, ranks, [*partition, value, "_slice"]).drop("_slice")


def _running_before(name: str, window: WindowSpec) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(name).over(before), F.lit(0))
