"""The three gold tables, built from silver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.functions.measures import against_target, bucketize, business_key, gap, pct, target_for_year
from estrato.operators.evolution import evolution
from estrato.operators.joins import spread_left_join
from estrato.operators.ranking import rank_within
from estrato.operators.rollup import sample_rollup
from estrato.operators.territory import with_region, with_territory
from estrato.plans.silver import TARGET_COLUMNS
from estrato.session import stage

# Network codes, the national goal for 2030, priority bounds and status labels.
MUNICIPAL_NETWORK = 3
WHOLE_STATE_NETWORK = 5
NATIONAL_GOAL_2030 = 80.0
PRIORITY_BOUNDS = (50, 70)
PRIORITY_LABELS = ("ALTA_PRIORIDADE", "MEDIA_PRIORIDADE", "BAIXA_PRIORIDADE")
ABOVE_NATIONAL_GOAL = "ACIMA_OU_IGUAL_META_2030"
REACHED_2030 = "ATINGIU_META_2030"
BELOW_2030 = "ABAIXO_META_2030"
REACHED_YEAR = "ATINGIU_META_ANUAL"
BELOW_YEAR = "ABAIXO_META_ANUAL"
NO_YEAR_TARGET = "SEM_META_ANUAL"
TARGET_UNAVAILABLE = "META_NAO_DISPONIVEL"
FIRST_YEAR = 2023

Keep = Callable[[DataFrame, str], DataFrame]

RUN_COLUMNS = ("_ingestion_date", "_execution_id")

_RATE = "taxa_alfabetizacao_pct"
_TARGET_2030 = TARGET_COLUMNS[2030]


def _valid_places(municipio: DataFrame) -> DataFrame:
    return municipio.filter(F.col("flag_id_municipio_valido") & F.col("flag_taxa_alfabetizacao_valida"))


def indicador_municipio(municipio: DataFrame, alunos: DataFrame) -> DataFrame:
    """Municipal results with territory, what the student sample shows, and the gap to the 2030 goal."""
    key = ["ano", "id_municipio", "serie", "rede"]
    results = with_territory(
        _valid_places(municipio).select(
            *key, _RATE, "media_portugues", "flag_possui_distribuicao_niveis", *RUN_COLUMNS
        ),
        "id_municipio",
    )
    rate, sample = F.col(_RATE), F.col("qtd_alunos_amostra")
    return results.join(sample_rollup(alunos, key), key, "left").select(
        "ano",
        "id_municipio",
        "codigo_uf",
        "sigla_uf",
        "regiao",
        "serie",
        "rede",
        _RATE,
        "media_portugues",
        "qtd_alunos_amostra",
        "qtd_alunos_alfabetizados_amostra",
        "qtd_alunos_presentes_amostra",
        pct(F.col("qtd_alunos_alfabetizados_amostra"), sample, 2).alias("taxa_alfabetizacao_alunos_amostra_pct"),
        pct(F.col("qtd_alunos_presentes_amostra"), sample, 2).alias("taxa_presenca_alunos_amostra_pct"),
        "media_proficiencia_alunos_amostra",
        "soma_peso_alunos_amostra",
        "flag_possui_distribuicao_niveis",
        against_target(rate, F.lit(NATIONAL_GOAL_2030), ABOVE_NATIONAL_GOAL, BELOW_2030).alias("status_meta_2030"),
        F.lit(NATIONAL_GOAL_2030).alias("meta_nacional_2030_pct"),
        gap(rate, F.lit(NATIONAL_GOAL_2030)).alias("diferenca_meta_2030_pp"),
        business_key(*key).alias("chave_gold_indicador_municipio"),
        *RUN_COLUMNS,
    )


def annual_status(value: Column, target: Column) -> Column:
    """Reached or below the target of the year; a label of its own when there is none."""
    return F.when(target.isNull(), F.lit(NO_YEAR_TARGET)).otherwise(
        against_target(value, target, REACHED_YEAR, BELOW_YEAR)
    )


def municipal_annual_status(year: Column, value: Column, target: Column) -> Column:
    """As ``annual_status``, but a missing target is only expected in the first year."""
    return (
        F.when(year == FIRST_YEAR, F.lit(NO_YEAR_TARGET))
        .when(target.isNull(), F.lit(TARGET_UNAVAILABLE))
        .otherwise(against_target(value, target, REACHED_YEAR, BELOW_YEAR))
    )


def metas_vs_resultados_municipio(municipio: DataFrame, metas: DataFrame) -> DataFrame:
    """Results of the municipal network against every target row of the same year and municipality.

    The targets' own network is not part of the join, so a municipality with several target rows appears
    once for each.
    """
    results = with_territory(
        _valid_places(municipio)
        .filter(F.col("rede") == MUNICIPAL_NETWORK)
        .select("ano", "id_municipio", "serie", "rede", _RATE, "media_portugues", *RUN_COLUMNS),
        "id_municipio",
    )
    targets = metas.filter("flag_id_municipio_valido").select(
        "ano",
        "id_municipio",
        F.col("rede").alias("rede_meta"),
        *TARGET_COLUMNS.values(),
        "nivel_alfabetizacao",
        "percentual_participacao_pct",
    )
    joined = results.join(targets, ["ano", "id_municipio"], "left").withColumn(
        "meta_ano_resultado_pct", target_for_year("ano", TARGET_COLUMNS)
    )
    rate, target = F.col(_RATE), F.col("meta_ano_resultado_pct")
    return joined.select(
        "ano",
        "id_municipio",
        "codigo_uf",
        "sigla_uf",
        "regiao",
        "serie",
        F.col("rede").alias("rede_resultado"),
        "rede_meta",
        rate.alias("resultado_alfabetizacao_pct"),
        "media_portugues",
        *TARGET_COLUMNS.values(),
        "meta_ano_resultado_pct",
        gap(rate, target).alias("diferenca_meta_ano_pp"),
        gap(rate, F.col(_TARGET_2030)).alias("diferenca_meta_2030_pp"),
        municipal_annual_status(F.col("ano"), rate, target).alias("status_meta_ano"),
        against_target(rate, F.col(_TARGET_2030), REACHED_2030, BELOW_2030).alias("status_meta_2030"),
        bucketize(rate, PRIORITY_BOUNDS, PRIORITY_LABELS).alias("faixa_prioridade_intervencao"),
        "nivel_alfabetizacao",
        "percentual_participacao_pct",
        business_key("ano", "id_municipio", "serie", "rede").alias("chave_gold_metas_vs_resultados_municipio"),
        *RUN_COLUMNS,
    )


_RESULT = "resultado_alfabetizacao_uf_pct"
_PREVIOUS = "resultado_alfabetizacao_uf_ano_anterior_pct"
_CHANGE = "variacao_alfabetizacao_uf_pp"


def _targets_per_key(targets: DataFrame, key: list[str], network: str) -> DataFrame:
    """How many target rows a key has, and which network comes first (NULL before text)."""
    return targets.groupBy(*key).agg(
        F.count(F.lit(1)).alias(f"_count{network}"), F.min(F.struct(network)).alias(f"_first{network}")
    )


def _is_first(network: str) -> Column:
    return F.col(f"_first{network}").isNull() | F.col(network).eqNullSafe(F.col(f"_first{network}")[network])


def evolucao_alfabetizacao_uf(
    uf: DataFrame, metas_uf: DataFrame, metas_brasil: DataFrame, keep: Keep = stage
) -> DataFrame:
    """State results over the years: change since the previous year, rank in the year, gaps and statuses.

    A result appears once per state target row and national target row of its year, and rank and previous value
    are defined over those copies. Copies of one result share its value, so both are computed on the results
    alone: the rank counts each result as many times as it will be copied; the first copy looks back to the row
    before, and every further copy sees its own value. No window runs after the tables fan out.

    ``keep`` stores the counted results, which several branches read; by default in the shared folder.
    """
    results = with_region(
        uf.filter("flag_sigla_uf_valida AND flag_taxa_alfabetizacao_valida")
        .filter(F.col("rede") == WHOLE_STATE_NETWORK)
        .select(
            "ano",
            "sigla_uf",
            "serie",
            F.col("rede").alias("rede_resultado"),
            F.col(_RATE).alias(_RESULT),
            "flag_possui_distribuicao_niveis",
            *RUN_COLUMNS,
        ),
        "sigla_uf",
    )
    state_targets = metas_uf.filter("flag_sigla_uf_valida").select(
        "ano",
        "sigla_uf",
        F.col("rede").alias("rede_meta"),
        *TARGET_COLUMNS.values(),
        F.col("percentual_participacao_pct").alias("percentual_participacao_uf_pct"),
        "flag_registro_com_indicadores",
    )
    national = metas_brasil.select(
        "ano",
        F.col("rede").alias("_rede_brasil"),
        F.col(_RATE).alias("taxa_alfabetizacao_brasil_pct"),
        F.col("percentual_participacao_pct").alias("percentual_participacao_brasil_pct"),
    )

    per_state = _targets_per_key(state_targets, ["ano", "sigla_uf"], "rede_meta")
    per_year = _targets_per_key(national, ["ano"], "_rede_brasil")
    counted = spread_left_join(
        results.join(per_state, ["ano", "sigla_uf"], "left"), per_year, ["ano"], spread_by=["sigla_uf", "serie"]
    )
    one = F.lit(1)
    copies = F.coalesce("_countrede_meta", one) * F.coalesce("_count_rede_brasil", one)
    base = keep(counted.withColumn("_copies", copies), "evolucao-base")

    over_time = evolution(
        base,
        _RESULT,
        partition=["sigla_uf", "rede_resultado"],
        period="ano",
        tiebreak=["serie"],
        previous=_PREVIOUS,
        change=_CHANGE,
    )
    ranked = rank_within(over_time, ["ano"], _RESULT, output="ranking_uf_no_ano", weight="_copies", counted=base)

    with_state = ranked.join(state_targets, ["ano", "sigla_uf"], "left")
    # The year alone has few values, so its rows are spread by state, grade and target network.
    fanned = spread_left_join(with_state, national, ["ano"], spread_by=["sigla_uf", "serie", "rede_meta"])
    first_copy = _is_first("rede_meta") & _is_first("_rede_brasil")
    fanned = (
        fanned.withColumn(_PREVIOUS, F.when(first_copy, F.col(_PREVIOUS)).otherwise(F.col(_RESULT)))
        .withColumn(_CHANGE, F.when(first_copy, F.col(_CHANGE)).otherwise(F.lit(0.0)))
        .withColumn("meta_ano_resultado_uf_pct", target_for_year("ano", TARGET_COLUMNS))
    )
    result, target, final = F.col(_RESULT), F.col("meta_ano_resultado_uf_pct"), F.col(_TARGET_2030)
    return fanned.select(
        "ano",
        "sigla_uf",
        "regiao",
        "serie",
        "rede_resultado",
        "rede_meta",
        _RESULT,
        _PREVIOUS,
        _CHANGE,
        "taxa_alfabetizacao_brasil_pct",
        gap(result, F.col("taxa_alfabetizacao_brasil_pct")).alias("diferenca_brasil_pp"),
        "meta_ano_resultado_uf_pct",
        gap(result, target).alias("diferenca_meta_ano_pp"),
        _TARGET_2030,
        gap(result, final).alias("diferenca_meta_2030_pp"),
        annual_status(result, target).alias("status_meta_ano"),
        against_target(result, final, REACHED_2030, BELOW_2030).alias("status_meta_2030"),
        "ranking_uf_no_ano",
        "percentual_participacao_uf_pct",
        "percentual_participacao_brasil_pct",
        "flag_possui_distribuicao_niveis",
        "flag_registro_com_indicadores",
        business_key("ano", "sigla_uf", "rede_resultado").alias("chave_gold_evolucao_alfabetizacao_uf"),
        *RUN_COLUMNS,
    )
