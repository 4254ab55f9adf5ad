"""Batch ingestion: read registered sources, stamp lineage, write bronze."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from estrato.config import LakeConfig, SourceSpec
from estrato.sources.layers import write_bronze
from estrato.sources.lineage import add_batch_lineage, execution_id

logger = logging.getLogger(__name__)

_DATASET = "br_inep_avaliacao_alfabetizacao"

# The six source tables, each loaded into a bronze table of the same name.
SOURCE_TABLES = (
    "uf",
    "alunos",
    "municipio",
    "meta_alfabetizacao_brasil",
    "meta_alfabetizacao_uf",
    "meta_alfabetizacao_municipio",
)


def default_sources(location: str, fmt: str = "parquet") -> list[SourceSpec]:
    """The registry of the six tables, exported to ``location/<table>``."""
    return [
        SourceSpec(t, _DATASET, t, t, fmt, {"path": f"{location.rstrip('/')}/{t}"}) for t in SOURCE_TABLES
    ]


def read_source(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """Read one whole source through any Spark reader (files, JDBC, a third-party connector)."""
    return spark.read.format(source.format).options(**source.options).load()


def ingest_source(
    spark: SparkSession,
    cfg: LakeConfig,
    source: SourceSpec,
    run_id: str,
    *,
    register: bool = False,
    preserve_history: bool = False,
    clock: Callable[[], datetime] | None = None,
) -> str:
    """Load one source into bronze and return the path written."""
    path = cfg.path("bronze", source.target_name)
    at = (clock or cfg.now)()
    df = read_source(spark, source)
    stamped = add_batch_lineage(df, source.name, source.dataset_id, source.table_id, run_id, at)
    write_bronze(
        stamped,
        path,
        database=cfg.databases["bronze"],
        table=source.target_name,
        register=register,
        preserve_history=preserve_history,
    )
    return path


def ingest(
    spark: SparkSession,
    cfg: LakeConfig,
    sources: Sequence[SourceSpec],
    *,
    only: str | None = None,
    register: bool = False,
    preserve_history: bool = False,
    clock: Callable[[], datetime] | None = None,
) -> dict[str, str]:
    """Load all enabled sources in order, or just ``only``; the first failure stops the run.

    Returns the bronze path of each source that was loaded.
    """
    if not sources:
        raise ValueError("the source registry is empty")
    run_id = execution_id((clock or cfg.now)())
    written: dict[str, str] = {}
    for source in sources:
        if not source.load_enabled:
            logger.info("skipping disabled source %s", source.name)
            continue
        if only and source.name != only:
            continue
        try:
            written[source.name] = ingest_source(
                spark,
                cfg,
                source,
                run_id,
                register=register,
                preserve_history=preserve_history,
                clock=clock,
            )
        except Exception:
            logger.exception("source %s failed; remaining sources are not loaded", source.name)
            raise
    return written
