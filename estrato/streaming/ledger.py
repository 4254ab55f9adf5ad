"""What a sink has already written, as ranges of offsets, so a repeated delivery is known without reading the sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estrato.session import path_exists, stage

# What names an event of a broker once and for all.
EVENT_ID = ("topic", "partition", "offset")
SOURCE = list(EVENT_ID[:2])
SCHEMA = "batch long, state string, low long, high long, topic string, partition int"
BEGUN, DONE = "begun", "done"


def _block(offset: str) -> Column:
    """The block of 65,536 offsets that ``offset`` lies in, so that no partition of the broker is one task's."""
    return F.shiftright(F.col(offset).cast("long"), 16)


def offset_ranges(events: DataFrame) -> DataFrame:
    """The offsets of ``events`` as gapless ranges per topic and partition: topic, partition, low, high.

    A range never covers an offset that is not there, so what it says is exact for any source. It ends where its block
    of offsets ends.
    """
    offsets = events.select(*EVENT_ID).distinct().withColumn("_block", _block("offset"))
    place = F.row_number().over(Window.partitionBy(*SOURCE, "_block").orderBy("offset"))
    runs = offsets.withColumn("run", F.col("offset") - place).groupBy(*SOURCE, "_block", "run")
    return runs.agg(F.min("offset").alias("low"), F.max("offset").alias("high")).drop("_block", "run")


def spans_of(events: DataFrame) -> list[tuple]:
    """First and last offset per topic and partition; a row for each partition of the broker."""
    rows = events.groupBy(*SOURCE).agg(F.min("offset").alias("low"), F.max("offset").alias("high")).collect()
    return [tuple(r) for r in rows]


def within(spans: list[tuple], low: str = "offset", high: str = "offset") -> Column:
    """Rows whose ``low`` to ``high`` meets a span of their own topic and partition; a filter that scans can use."""
    found = F.lit(False)
    for topic, partition, first, last in spans:
        own = F.col("topic").eqNullSafe(F.lit(topic)) & F.col("partition").eqNullSafe(F.lit(partition))
        found = found | (own & (F.col(low) <= last) & (F.col(high) >= first))
    return found


def _covered(events: DataFrame, ranges: DataFrame, wanted: bool) -> DataFrame:
    """The events whose offset lies in a range of their own topic and partition, or those whose offset does not.

    Each block of offsets is sorted once: a range covers an offset if the furthest end among the ranges that begin at
    or before it reaches it. An event is never paired with the ranges of its partition.
    """
    blocks = F.explode(F.sequence(_block("low"), _block("high"))).alias("_block")
    ends = ranges.select(*SOURCE, F.col("low").alias("offset"), F.col("high").alias("_end"), blocks)
    marked = events.withColumns({"_block": _block("offset"), "_event": F.lit(True)})
    both = marked.unionByName(ends, allowMissingColumns=True)
    reach = F.max("_end").over(Window.partitionBy(*SOURCE, "_block").orderBy("offset"))  # peers count
    covered = F.coalesce(reach >= F.col("offset"), F.lit(False))
    chosen = both.withColumn("_covered", covered).where(F.col("_event") & (F.col("_covered") == F.lit(wanted)))
    return chosen.select(*events.columns)


class OffsetLedger:
    """The ranges that a sink has begun and done, as Parquet files in folders by topic and partition."""

    def __init__(self, path: str):
        self.path = path

    def rows(self, spark: SparkSession) -> DataFrame:
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).parquet(self.path)

    def note(self, ranges: DataFrame, batch_id: int, state: str) -> None:
        noted = ranges.select(F.lit(batch_id).cast("long").alias("batch"), F.lit(state).alias("state"), "low", "high", *SOURCE)
        noted.write.mode("append").partitionBy(*SOURCE).parquet(self.path)


def write_once(
    events: DataFrame,
    batch_id: int,
    ledger: OffsetLedger,
    held: Callable[[], DataFrame | None],
    write: Callable[[DataFrame], None],
) -> None:
    """Write those of ``events`` that the sink does not hold.

    Ranges are noted as begun before a write and as done after it. Offsets that are done are left out by the ledger
    alone. Only offsets that were begun and never done, because a write failed somewhere, are looked up in the sink
    (``held``), and only those; a first delivery reads the folders of its own partitions of the ledger and nothing
    else. An event that comes twice in ``events`` is written once.
    """
    spark = events.sparkSession
    spans = spans_of(events)
    if not spans:
        return
    noted = stage(ledger.rows(spark).where(within(spans, "low", "high")), "ledger")
    done, begun = (noted.where(F.col("state") == state) for state in (DONE, BEGUN))
    fresh = events if done.isEmpty() else _covered(events, done, False)
    due = stage(offset_ranges(fresh), "due")
    if due.isEmpty():
        return
    doubtful = [] if begun.isEmpty() else spans_of(_covered(fresh.select(*EVENT_ID), begun, True))
    ledger.note(due, batch_id, BEGUN)
    todo = fresh.dropDuplicates(list(EVENT_ID))
    sink = held() if doubtful else None
    if sink is not None:
        known = sink.where(within(doubtful)).select(*EVENT_ID)
        # Staged: the write changes what the sink holds, and with it what a later look would leave over.
        todo = stage(todo.join(known, [*EVENT_ID], "left_anti"), "missing")
    write(todo)
    ledger.note(due, batch_id, DONE)
