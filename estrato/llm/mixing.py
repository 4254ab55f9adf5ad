"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact word length within their source. Whole repeats of a source and an even share of every
length cover most of a target, a seeded draw over the lengths what is left above a window, and a bounded knapsack over
lengths fits the rest to the word. Which documents of a length are taken is settled by a seeded hash of their id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import WORD
from estrato.session import stage

BUDGET = 1 << 14  # words that the knapsack fits at least
LONGEST = 4  # times the longest document's words that the knapsack fits at least
SLICES = 1 << 10  # parts of a (source, length) group, by the seeded hash


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0) -> DataFrame:
    """Adds ``target`` to ``sizes`` (``source``, ``source_size``; one row per source).

    Sources in code-point order, null last, weigh ``weights`` in turn and share the sum of all sizes. A target stops
    at ``most`` times its source's size; the excess is shared by weight among the others until none is above. That
    fixed point is one water level: sources fill up in the order of capacity per weight. The windows run over one row
    per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "place")
    everywhere = Window.partitionBy()
    turn = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("place", F.row_number().over(by_name)).withColumns(
        {
            "weight": F.element_at(turn, ((F.col("place") - 1) % len(weights) + 1).cast("int")),
            "capacity": F.col("source_size") * F.lit(float(most)),
            "total": F.sum("source_size").over(everywhere).cast("double"),
        }
    )
    rows = rows.withColumn("room", F.col("capacity") / F.col("weight")).withColumns(
        {
            "full": F.coalesce(
                F.sum("capacity").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
            ),
            "open": F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)),
            "rank": F.row_number().over(by_room),
        }
    )
    level = (F.col("total") - F.col("full")) / F.col("open")
    rows = rows.withColumn("level", F.when(level <= F.col("room"), level))
    first = F.min(F.when(F.col("level").isNotNull(), F.struct("rank", "level"))).over(everywhere)
    target = F.least("capacity", F.coalesce(first["level"] * F.col("weight"), F.col("capacity")))
    return rows.withColumn("target", target).select(*sizes.columns, "target")


def knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take so that their sum is the largest that does not exceed ``budget``."""
    taken = np.zeros(len(sizes), np.int64)
    unit = int(np.gcd.reduce(sizes[counts > 0], initial=0))
    budget = min(budget, int((sizes * counts).sum()))
    if budget <= 0:
        return taken
    sizes, budget = sizes // unit, budget // unit  # only multiples of the unit are sums
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    through = np.full(budget + 1, -1, np.int32)
    lots: list[tuple[int, int, int]] = []
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        left, lot = (min(int(counts[i]), budget // size) if size > 0 else 0), 1
        while left and not reached[budget]:
            lot = min(lot, left)
            step = lot * size
            fresh = np.flatnonzero(reached[: budget + 1 - step] & ~reached[step:]) + step
            reached[fresh], through[fresh] = True, len(lots)
            lots.append((int(i), lot, step))
            left, lot = left - lot, lot * 2
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, lot, step = lots[through[at]]
        taken[i] += lot
        at -= step
    return taken


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int = 0) -> np.ndarray:
    """Documents of each size for ``budget`` words: an even share, a seeded draw, then the knapsack.

    The draw takes a document of every so many lengths, from a seeded start along the sorted lengths, so that short and
    long ones keep their share. It stops at a window that still holds the longest document several times; there the
    knapsack finds the best sum of the documents left. If that misses the budget and the budget itself lies within the
    window, the knapsack chooses among all documents instead of those left by the even share.
    """
    total = int((sizes * counts).sum())
    budget = min(budget, total)
    if budget <= 0:
        return np.zeros(len(sizes), np.int64)
    window = max(BUDGET, LONGEST * int(sizes[counts > 0].max()))
    taken = np.array([min(int(c), int(c) * budget // total) for c in counts], np.int64)
    rest = budget - int((sizes * taken).sum())
    rng = np.random.default_rng(seed)
    by_size = np.argsort(sizes, kind="stable")
    part = (counts * (budget / total) - taken)[by_size].cumsum() + rng.random()
    drawn = np.floor(part) > np.floor(np.concatenate([[0.0], part[:-1]]))
    # The lengths drawn in seeded order, then, as shares may round to too few words, the others.
    mixed = rng.permutation(len(sizes))
    order = by_size[mixed[np.argsort(~drawn[mixed], kind="stable")]]
    while rest > window:
        for i in order:
            if rest > window and taken[i] < counts[i] and sizes[i]:
                taken[i] += 1
                rest -= int(sizes[i])
    taken += knapsack(sizes, counts - taken, rest)
    if budget <= window and int((sizes * taken).sum()) < budget:
        again = knapsack(sizes, counts, budget)
        if (sizes * again).sum() > (sizes * taken).sum():
            taken = again
    return taken


def _plan(group: pd.DataFrame, seed: int) -> pd.DataFrame:
    group = group.sort_values("size")
    size, target, source = int(group.source_size.iloc[0]), float(group.target.iloc[0]), group.source.iloc[0]
    whole = int(target // size) if size else 0
    seed = zlib.crc32(f"{seed} {source or ''}".encode("utf-8", "surrogatepass"))
    words = round(target - whole * size) if size else 0
    extra = fit(group["size"].to_numpy(), group.documents.to_numpy(), words, seed)
    return group.assign(whole=whole, extra=extra)[["source", "size", "source_size", "target", "whole", "extra"]]


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    most: float = 3.0,
    seed: int = 7,
) -> DataFrame:
    """One row per row of ``docs``: id, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``size`` is the number of words; ``copies`` how often the mix takes the document, at most ``most`` rounded up;
    ``taken`` is ``copies * size``. The words taken from a source are the best sum that the documents left by
    share and draw allow, mostly its target to the word. Null text has size 0; a null source is a source of its own; a source without words has
    target 0. Among documents of one source and length, the smallest seeded hashes of the id are taken, so reruns
    agree; rows with the same id are interchangeable. No rows give no rows; other columns are not read.

    Only (id, source, size) is kept of a document, written once to the shared folder. A (source, length) group is
    counted in hash slices, so one that holds a third of all rows is never gathered. The plan of a source sees one
    row per length.
    """
    narrow = docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size")
    )
    key = F.xxhash64(F.lit(seed), F.col("id"))
    narrow = stage(narrow.withColumns({"key": key, "slice": F.pmod(key, F.lit(SLICES)).cast("int")}), "mixing")

    lengths = narrow.groupBy("source", "size").agg(F.count(F.lit(1)).alias("documents"))
    sizes = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("documents")).alias("source_size"))
    # Null sources take part in joins under a flag and an empty name.
    named = lambda df: df.withColumns(
        {"no_source": F.col("source").isNull(), "name": F.coalesce("source", F.lit(""))}
    )
    targets = named(source_targets(sizes)).drop("source")
    plan = (
        named(lengths)
        .join(targets, ["no_source", "name"])
        .groupBy("no_source", "name")
        .applyInPandas(
            lambda group: _plan(group, seed), "source string, size bigint, source_size bigint, target double, whole bigint, extra bigint"
        )
    )
    plan = stage(named(plan).drop("source"), "mixing-plan")

    group = ["no_source", "name", "size"]
    slices = named(narrow).groupBy(*group, "slice").agg(F.count(F.lit(1)).alias("documents"))
    earlier = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("documents").over(earlier), F.lit(0))
    quota = (
        slices.withColumn("before", before)
        .join(plan, group)
        .withColumn("quota", F.greatest(F.col("extra") - F.col("before"), F.lit(0)))
        .drop("documents", "before", "extra")
    )
    place = F.row_number().over(Window.partitionBy(*group, "slice").orderBy("key", "id"))
    copies = F.col("whole") + F.when(F.col("place") <= F.col("quota"), 1).otherwise(0)
    return (
        named(narrow)
        .withColumn("place", place)
        .join(quota, [*group, "slice"])
        .withColumn("copies", copies)
        .select(
            F.col("id").alias(id_column),
            F.col("source").alias("source"),
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The rows of ``docs`` (with doc_id, source and text) as often as the mix takes them, all columns kept.

    Rows that agree in id, source and length take the decisions of their group in the order of a hash of the text.
    """
    decided = mix(docs, **options)
    same = ["__id", "__source", "__size"]
    decided = decided.select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "copies"
    ).withColumn("__place", F.row_number().over(Window.partitionBy(*same).orderBy(F.desc("copies"))))
    rows = docs.withColumns(
        {"__id": F.col("doc_id"), "__source": F.col("source"), "__size": word_count(F.col("text"))}
    ).withColumn("__place", F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64("text"))))
    rows, decided = rows.alias("r"), decided.alias("d")
    equal = [F.col(f"r.{c}").eqNullSafe(F.col(f"d.{c}")) for c in [*same, "__place"]]
    taken = rows.join(decided, equal).where("d.copies > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("d.copies")))).select(
        *[F.col(f"r.{c}") for c in docs.columns]
    )
