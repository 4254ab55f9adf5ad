"""Keep the newest row of each business key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 64  # parts of the rows that share a key with NULL


def latest_by_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column], *, names_rows: bool = False
) -> DataFrame:
    """One row per key, the one that is last by ``newest_first``: names or expressions, NULL counting as oldest.

    Keys that hold NULL form groups of their own, as in SQL grouping. Rows that tie on ``newest_first`` are told
    apart by all remaining columns, so the choice never depends on how the data was split; rows that still tie
    are identical. Spark trims every map task to one row per key before the shuffle, so a key that holds a large
    share of the table reaches its reducer as at most one row per map task.

    A hash of the key leads the partition columns: groups stay the same, and the sorts before and after the
    shuffle settle nearly every comparison on one number instead of walking key columns with few distinct values.

    ``names_rows`` says that a key without NULL names a single row of a source, which comes only as often as it is
    delivered. Trimming would sort, and spill, whole map tasks to find next to nothing, so such keys go to the shuffle
    as they are, without the hash, and are sorted once. A missing id may be that of a third of the table, so keys that
    hold NULL go there in ``SPREAD`` parts, and are trimmed behind it. Both read the same shuffle: ``df`` is read once.
    """
    if names_rows:
        whole = reduce(and_, [F.col(name).isNotNull() for name in keys])
        part = F.when(whole, F.lit(0)).otherwise(F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD)).cast("int"))
        dealt = df.withColumn("_part", part).repartition(*keys, "_part")
        # A one-element inline: the filters on its result are not pushed below it, where they would part the shuffle.
        told = dealt.select("*", F.inline(F.array(F.struct(whole.alias("_whole")))))
        named, unnamed = told.where("_whole").drop("_whole"), told.where("NOT _whole").drop("_whole", "_part")
        return (
            latest_by_key(named, [*keys, "_part"], newest_first)
            .drop("_part")
            .unionByName(latest_by_key(unnamed, keys, newest_first))
        )
    named = [c for c in newest_first if isinstance(c, str)]
    rest = [c for c in df.columns if c not in keys and c not in named]
    # Expressions become columns first: a sort would work them out again in every comparison.
    made = {f"_newest_{n}": c for n, c in enumerate(newest_first) if not isinstance(c, str)}
    newest = [F.col(c) if isinstance(c, str) else F.col(f"_newest_{n}") for n, c in enumerate(newest_first)]
    order = [c.desc_nulls_last() for c in newest] + [F.col(c).asc_nulls_last() for c in rest]
    place = F.row_number().over(Window.partitionBy("_key_hash", *keys).orderBy(*order))
    hashed = df.withColumns({"_key_hash": F.xxhash64(*keys), **made})
    return hashed.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place", "_key_hash", *made)
