"""Enrich rows with state and region. The lookup side is a constant of 27 rows, so broadcasting it is safe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.functions.territory import states


def with_territory(df: DataFrame, place_id: str) -> DataFrame:
    """Add codigo_uf (first two characters of ``place_id``), sigla_uf and regiao; NULL for an unknown code."""
    coded = df.withColumn("codigo_uf", F.substring(F.col(place_id).cast("string"), 1, 2))
    return coded.join(F.broadcast(states(df.sparkSession)), "codigo_uf", "left")


def with_region(df: DataFrame, acronym: str) -> DataFrame:
    """Add regiao from a state acronym; NULL for an unknown one."""
    regions = states(df.sparkSession).select(F.col("sigla_uf").alias(acronym), "regiao")
    return df.join(F.broadcast(regions), acronym, "left")
