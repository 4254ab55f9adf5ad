"""Aggregates of a student sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _exact(name: str) -> Column:
    """A measure to nine decimals, so that sums do not depend on the order of tasks."""
    return F.col(name).try_cast("decimal(28,9)")


def _sum(name: str) -> Column:
    """Of the measures that are decimals, plus those that are none: NaN, infinite or of 1e19 and more."""
    total, others = F.sum(_exact(name)).cast("double"), F.sum(F.when(_exact(name).isNull(), F.col(name)))
    return F.when(others.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + others)


def _mean(name: str) -> Column:
    rows = F.count(name)
    return F.when(rows > 0, _sum(name) / rows)


def sample_rollup(students: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts, mean proficiency and total weight per group, over identified students of valid municipalities.

    Only plain aggregates, so every map task sends at most one row per group. Sums run over decimals of nine places; values
    that are none (NaN, infinite, very large) are added as they are.
    """
    usable = students.filter(F.col("flag_id_municipio_valido") & F.col("flag_id_aluno_preenchido"))
    return usable.groupBy(*by).agg(
        F.count(F.lit(1)).alias("qtd_alunos_amostra"),
        F.count_if(F.col("alfabetizado") == 1).alias("qtd_alunos_alfabetizados_amostra"),
        F.count_if(F.col("presenca") == 1).alias("qtd_alunos_presentes_amostra"),
        _mean("proficiencia").alias("media_proficiencia_alunos_amostra"),
        _sum("peso_aluno").alias("soma_peso_alunos_amostra"),
    )
