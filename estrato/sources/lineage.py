"""The seven lineage columns every bronze and silver row carries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINEAGE = (
    "_source_system",
    "_source_name",
    "_source_dataset_id",
    "_source_table_id",
    "_ingestion_timestamp_utc",
    "_ingestion_date",
    "_execution_id",
)

# Origin names and the execution id format.
BATCH_SYSTEM = "base_dos_dados"
STREAM_SYSTEM = "kafka_stream"
STREAM_DATASET = "br_inep_avaliacao_alfabetizacao"
STREAM_TABLE = "uf"
EXECUTION_ID_FORMAT = "%Y%m%dT%H%M%SZ"


def execution_id(at: datetime) -> str:
    """Run id in the lake's local time; the trailing Z is part of the format, not a zone."""
    return at.strftime(EXECUTION_ID_FORMAT)


def _stamp(df: DataFrame, values: tuple[Column, ...]) -> DataFrame:
    return df.withColumns(dict(zip(LINEAGE, values, strict=True)))


def add_batch_lineage(
    df: DataFrame, source_name: str, dataset_id: str, table_id: str, run_id: str, at: datetime
) -> DataFrame:
    """Stamp one batch. ``at`` is taken once per source, so all its rows share one timestamp."""
    return _stamp(
        df,
        (
            F.lit(BATCH_SYSTEM),
            F.lit(source_name),
            F.lit(dataset_id),
            F.lit(table_id),
            F.lit(at.isoformat()),
            F.lit(at.date().isoformat()),
            F.lit(run_id),
        ),
    )


def stream_offset() -> Column:
    """The offset that a stream's execution id names, as a number; NULL for a batch row."""
    # A failing cast costs an exception a row, so the empty text of a batch row becomes NULL before it.
    return F.nullif(F.regexp_extract("_execution_id", r"_offset(\d+)$", 1), F.lit("")).try_cast("bigint")


def add_stream_lineage(
    df: DataFrame, source_name: str, at: datetime, offset: str = "offset", arrived: str = "timestamp"
) -> DataFrame:
    """Stamp one micro-batch; the execution id names each event's offset.

    Every event carries its own arrival, the broker's ``arrived`` column in the zone of ``at``, as text of fixed
    width. An event without one has ``at``.
    """
    zone = at.isoformat()[-6:] if at.tzinfo else "+00:00"
    stamp, day = F.lit(at.isoformat()), F.lit(at.date().isoformat())
    if arrived in df.columns:
        local = F.convert_timezone(
            F.current_timezone(), F.lit(zone), F.col(arrived).cast("timestamp").cast("timestamp_ntz")
        )
        own = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(zone))
        stamp, day = F.coalesce(own, stamp), F.coalesce(F.date_format(local, "yyyy-MM-dd"), day)
    return _stamp(
        df,
        (
            F.lit(STREAM_SYSTEM),
            F.lit(source_name),
            F.lit(STREAM_DATASET),
            F.lit(STREAM_TABLE),
            stamp,
            day,
            F.format_string(f"stream_{execution_id(at)}_offset%d", F.col(offset)),
        ),
    )
