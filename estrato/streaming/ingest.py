"""Streaming ingestion into a relational mirror and the bronze table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from estrato.config import LakeConfig
from estrato.session import path_exists
from estrato.sources.layers import read_table, stream_table, write_bronze
from estrato.sources.lineage import LINEAGE, add_stream_lineage
from estrato.streaming.events import FIELDS, REASON, parse_events, split_valid
from estrato.streaming.ledger import EVENT_ID, OffsetLedger, spans_of, within, write_once

logger = logging.getLogger(__name__)

EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"

BatchSink = Callable[[DataFrame, int], None]


def kafka_events(
    spark: SparkSession, servers: str, topic: str, per_batch: int = 10_000_000, **options: str
) -> DataFrame:
    """The topic from its first offset; the query's checkpoint, not a consumer group, remembers progress.

    ``per_batch`` bounds one micro-batch, so a long backlog is read in steps instead of all at once; nothing is
    left out. Needs Spark's Kafka connector on the classpath. Any other stream with Kafka's columns works as well.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_batch)
    )
    return reader.options(**options).load()


def not_held(batch: DataFrame, held: DataFrame | None) -> DataFrame:
    """The events of ``batch`` that ``held`` has no row of, by topic, partition and offset.

    Only the offsets that the batch spans in each partition are looked up, a filter that reaches the scan of ``held``.
    """
    events = batch.select(*EVENT_ID, *FIELDS)
    spans = spans_of(events) if held is not None else []
    if not spans:
        return events
    return events.join(held.where(within(spans)).select(*EVENT_ID), [*EVENT_ID], "left_anti")


def jdbc_mirror(
    url: str, table: str, properties: Mapping[str, str] | None = None, ledger: str | None = None
) -> BatchSink:
    """A sink that appends event ids and the 15 business columns to a relational table, one transaction per task.

    The table must exist. A batch that is delivered again, whole or in part, leaves no event twice. With ``ledger``,
    a folder for the ranges already written, a repeated batch is recognised without reading the table; without it,
    or for ranges whose write failed, rows are left out whose topic, partition and offset the table holds.
    """
    options = dict(properties or {})

    def append(batch: DataFrame, batch_id: int) -> None:
        held = lambda: batch.sparkSession.read.jdbc(url, table, properties=options)
        write = lambda rows: rows.write.jdbc(url, table, mode="append", properties=options)
        if ledger is None:
            write(not_held(batch, held()))
        else:
            write_once(batch.select(*EVENT_ID, *FIELDS), batch_id, OffsetLedger(ledger), held, write)

    return append


def parquet_mirror(path: str, ledger: str | None = None) -> BatchSink:
    """The same mirror as Parquet files."""

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = lambda: read_table(spark, path) if path_exists(spark, path) else None
        write = lambda rows: rows.write.mode("append").parquet(path)
        if ledger is None:
            write(not_held(batch, held()))
        else:
            write_once(batch.select(*EVENT_ID, *FIELDS), batch_id, OffsetLedger(ledger), held, write)

    return append


def bronze_sink(cfg: LakeConfig, target: str, clock: Callable[[], datetime] | None = None) -> BatchSink:
    """A sink that appends events with lineage to the stream's bronze table, beside the batch ingest's own.

    Both writers keep their own column types and histories; silver is built from both.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        at = (clock or cfg.now)()
        rows = add_stream_lineage(batch, target, at).select(*FIELDS, *LINEAGE)
        write_bronze(rows, cfg.path("bronze", stream_table(target)), mode="append")

    return append


def deliver(
    batch: DataFrame,
    batch_id: int,
    *,
    mirror: BatchSink | None,
    bronze: BatchSink | None,
    rejects: BatchSink | None,
    bronze_may_fail: bool = False,
) -> None:
    """Write one micro-batch: mirror, then bronze, then rejected events.

    A failing mirror fails the micro-batch before bronze is touched, and a restart delivers it again. So does a
    failing bronze write, unless ``bronze_may_fail`` says that the mirror's rows are enough; it is then logged.
    Without a sink for them, rejected events are counted by reason and logged. Delivery is at least once; the mirror
    leaves out events it holds, and silver keeps one row per key.
    """
    parsed = parse_events(batch).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        accepted, rejected = split_valid(parsed)
        if mirror is not None:
            mirror(accepted, batch_id)
        if bronze is not None:
            try:
                bronze(accepted, batch_id)
            except Exception:
                if mirror is None or not bronze_may_fail:
                    raise
                logger.warning("bronze write failed for micro-batch %s", batch_id, exc_info=True)
        if rejects is not None:
            rejects(rejected, batch_id)
        else:
            for row in rejected.groupBy(REASON).count().collect():  # a row per reason
                logger.warning("micro-batch %s: %s events rejected (%s)", batch_id, row["count"], row[REASON])
    finally:
        parsed.unpersist()


def start_ingest(
    events: DataFrame,
    checkpoint: str,
    *,
    mirror: BatchSink | None = None,
    bronze: BatchSink | None = None,
    rejects: BatchSink | None = None,
    bronze_may_fail: bool = False,
    available_now: bool = False,
    processing_time: str = "10 seconds",
) -> StreamingQuery:
    """Start the query. ``events`` has Kafka's columns; leave a sink out to switch it off.

    With ``available_now`` the query ends with the data there is: no micro-batches without data follow, which a state
    with time-outs would ask for without end.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        deliver(
            batch, batch_id, mirror=mirror, bronze=bronze, rejects=rejects, bronze_may_fail=bronze_may_fail
        )

    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time}
    writer = events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger)
    conf = events.sparkSession.conf
    before = conf.get(EMPTY_BATCHES)
    try:
        if available_now:
            conf.set(EMPTY_BATCHES, "false")  # the query takes its settings from the session as it starts
        return writer.start()
    finally:
        conf.set(EMPTY_BATCHES, before)
