"""The questions the gold tables are made to answer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.plans.gold import BELOW_YEAR

_EXACT = "decimal(9,4)"


def municipalities_below_target(metas_vs_resultados: DataFrame) -> DataFrame:
    """Municipalities whose result missed the target of its year, with the size of the gap."""
    return metas_vs_resultados.filter(F.col("status_meta_ano") == BELOW_YEAR).select(
        "ano",
        "id_municipio",
        "sigla_uf",
        "regiao",
        "serie",
        "rede_meta",
        "resultado_alfabetizacao_pct",
        "meta_ano_resultado_pct",
        "diferenca_meta_ano_pp",
        "faixa_prioridade_intervencao",
    )


def best_evolving_states(evolucao: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` largest year-on-year gains. Only the leading rows of each task reach the driver's merge."""
    return (
        evolucao.filter(F.col("variacao_alfabetizacao_uf_pp").isNotNull())
        .select(
            "ano",
            "sigla_uf",
            "regiao",
            "serie",
            "resultado_alfabetizacao_uf_pct",
            "resultado_alfabetizacao_uf_ano_anterior_pct",
            "variacao_alfabetizacao_uf_pp",
        )
        .distinct()
        .orderBy(
            F.col("variacao_alfabetizacao_uf_pp").desc(),
            "ano",
            "sigla_uf",
            "serie",
            "resultado_alfabetizacao_uf_pct",
            "resultado_alfabetizacao_uf_ano_anterior_pct",
        )
        .limit(top)
    )


def regional_inequality(evolucao: DataFrame) -> DataFrame:
    """Spread of state results inside each year and region. A state with several target rows counts once.

    The mean is taken over decimals, so it does not depend on the order in which tasks finish.
    """
    rate = F.col("resultado_alfabetizacao_uf_pct")
    states = evolucao.select("ano", "regiao", "sigla_uf", "serie", rate).distinct()
    low, high = F.min(rate), F.max(rate)
    return states.groupBy("ano", "regiao").agg(
        F.count(F.lit(1)).alias("qtd_resultados"),
        F.round(F.avg(rate.cast(_EXACT)), 4).cast("double").alias("media_pct"),
        low.alias("menor_pct"),
        high.alias("maior_pct"),
        F.round(high - low, 2).alias("amplitude_pp"),
        F.round(F.stddev_samp(rate), 4).alias("desvio_padrao"),
    )
