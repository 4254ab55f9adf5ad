"""Leave out of a stream the events that can no longer be the newest of their business key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from estrato.session import ship_package
from estrato.streaming.events import parse_events, split_valid

# Stand for NULL inside the state step, where a NULL would turn whole numbers into floats.
NEVER = -(1 << 63)
NOWHERE = -1

_MOVED = "topic string, partition int, offset bigint, value binary, _came bigint"
_STATE = "came bigint, offset bigint"


def _step(idle_ms: int):
    """One group of a micro-batch: give back the events that come last, if nothing seen before comes after them."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            if state.get[0] < state.getCurrentWatermarkMs() * 1000:
                state.remove()
            else:
                state.setTimeoutDuration(idle_ms)
            return
        last = tuple(state.get) if state.exists else (NEVER, NOWHERE)
        kept: list[pd.DataFrame] = []
        for part in parts:
            part = part[["topic", "partition", "offset", "value", "_came"]]
            undated = part["_came"] == NEVER
            if undated.any():
                yield part[undated]
                part = part[~undated]
            if part.empty:
                continue
            latest = part["_came"].max()
            part = part[part["_came"] == latest]
            place = (int(latest), int(part["offset"].max()))
            if place < last:
                continue
            if place > last:
                last, kept = place, []
            kept.append(part[part["offset"] == last[1]].drop_duplicates(["topic", "partition"]))
            if len(kept) > 64:  # the same event many times over
                kept = [pd.concat(kept).drop_duplicates(["topic", "partition"])]
        if last[0] != NEVER:
            state.update(last)
            state.setTimeoutDuration(idle_ms)
        yield from kept

    return run


def newest_only(
    events: DataFrame, key: Sequence[str], *, lateness: str = "1 day", idle_ms: int = 600_000, spread: int = 8
) -> DataFrame:
    """The accepted events of a stream in the broker's columns, without those that an earlier event outdates.

    ``events`` has Kafka's columns, and so has the result, which any sink takes as it takes the whole stream. For each
    ``key`` (names of event fields) the state holds the arrival and the offset of its newest event; an event goes on
    only if nothing newer came before it. So keeping the newest row of each key gives the same rows after this step as
    without it, in whatever order and however often events come: what goes on again is settled there. Events without
    an arrival always go on, since theirs is the time of the micro-batch. Rejected events do not go on; the query that
    mirrors the whole stream tells of them.

    A key that was idle for ``idle_ms`` is looked at again, and its state is dropped once its newest event lies behind
    the watermark, ``lateness`` before the newest arrival. No event is left out for being late: where the state is
    gone it goes on and is settled later. Expiry looks at idle keys by the clock for that reason, since a timeout by
    event time would make Spark drop late rows.

    ``spread`` deals each key over so many groups by a hash of the event's place, so that a key with a third of all
    events is not one task's; each group lets its own newest event pass.

    A state is two numbers, so the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``) keeps many
    millions of keys a task outside the heap.
    """
    ship_package(events.sparkSession)
    arrival = events.schema["timestamp"].dataType
    accepted, _ = split_valid(parse_events(events.withColumn("_value", F.col("value"))))
    came = F.unix_micros(F.col("timestamp").cast("timestamp"))
    moved = accepted.select(
        "topic",
        F.coalesce("partition", F.lit(NOWHERE)).cast("int").alias("partition"),
        F.coalesce("offset", F.lit(NOWHERE)).cast("bigint").alias("offset"),
        F.col("_value").cast("binary").alias("value"),
        F.coalesce(came, F.lit(NEVER)).alias("_came"),
        F.col("timestamp").cast("timestamp").alias("_event_time"),
        *[F.col(name).alias(f"_key_{name}") for name in key],
        F.pmod(F.xxhash64("topic", "partition", "offset"), F.lit(spread)).alias("_part"),
    )
    groups = moved.withWatermark("_event_time", lateness).groupBy(*[f"_key_{name}" for name in key], "_part")
    passed = groups.applyInPandasWithState(
        _step(idle_ms), _MOVED, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    return passed.select(
        "topic",
        F.nullif("partition", F.lit(NOWHERE)).alias("partition"),
        F.nullif("offset", F.lit(NOWHERE)).alias("offset"),
        F.timestamp_micros(F.nullif("_came", F.lit(NEVER))).cast(arrival).alias("timestamp"),
        "value",
    )
