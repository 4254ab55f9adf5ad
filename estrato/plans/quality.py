"""The check suite over the six silver tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame

from estrato.functions import flags
from estrato.operators.checks import CheckSpec, Measures, run_checks

_RATE = "taxa_alfabetizacao_pct"
_PARTICIPATION = "percentual_participacao_pct"
_TARGET_2030 = "meta_alfabetizacao_2030_pct"


def _not_in_range(name: str) -> Callable[[], Column]:
    return lambda: ~flags.in_range(name, 0, 100)


def _wrong_length(name: str, size: int) -> Callable[[], Column]:
    return lambda: ~flags.length_is(name, size)


def _not_binary(name: str) -> Callable[[], Column]:
    return lambda: ~flags.in_set(name, (0, 1))


def _negative(name: str) -> Callable[[], Column]:
    return lambda: flags.below(name, 0)


def _flag_down(name: str) -> Callable[[], Column]:
    return lambda: flags.is_false(name)


def _not_goal(name: str) -> Callable[[], Column]:
    return lambda: ~flags.equals(name, 80)


# Table, check name, check type and description of every check, in report order.
CHECKS = (
    CheckSpec(
        "uf", "duplicate_key_ano_sigla_uf_serie_rede", "DUPLICIDADE",
        "Valida duplicidade na chave ano + sigla_uf + serie + rede",
        unique=("ano", "sigla_uf", "serie", "rede"),
    ),
    CheckSpec(
        "uf", "invalid_sigla_uf", "VALIDADE",
        "Valida se sigla_uf está preenchida e possui 2 caracteres",
        fails=_wrong_length("sigla_uf", 2),
    ),
    CheckSpec(
        "uf", "invalid_taxa_alfabetizacao", "VALIDADE",
        "Valida se taxa_alfabetizacao_pct está preenchida e entre 0 e 100",
        fails=_not_in_range(_RATE),
    ),
    CheckSpec(
        "uf", "invalid_quality_flag_sigla_uf", "CONSISTENCIA_FLAG",
        "Valida a flag técnica flag_sigla_uf_valida",
        fails=_flag_down("flag_sigla_uf_valida"),
    ),
    CheckSpec(
        "uf", "invalid_quality_flag_taxa_alfabetizacao", "CONSISTENCIA_FLAG",
        "Valida a flag técnica flag_taxa_alfabetizacao_valida",
        fails=_flag_down("flag_taxa_alfabetizacao_valida"),
    ),
    CheckSpec(
        "municipio", "duplicate_key_ano_id_municipio_serie_rede", "DUPLICIDADE",
        "Valida duplicidade na chave ano + id_municipio + serie + rede",
        unique=("ano", "id_municipio", "serie", "rede"),
    ),
    CheckSpec(
        "municipio", "invalid_id_municipio", "VALIDADE",
        "Valida se id_municipio está preenchido e possui 7 caracteres",
        fails=_wrong_length("id_municipio", 7),
    ),
    CheckSpec(
        "municipio", "invalid_taxa_alfabetizacao", "VALIDADE",
        "Valida se taxa_alfabetizacao_pct está preenchida e entre 0 e 100",
        fails=_not_in_range(_RATE),
    ),
    CheckSpec(
        "municipio", "invalid_quality_flag_id_municipio", "CONSISTENCIA_FLAG",
        "Valida a flag técnica flag_id_municipio_valido",
        fails=_flag_down("flag_id_municipio_valido"),
    ),
    CheckSpec(
        "municipio", "invalid_quality_flag_taxa_alfabetizacao", "CONSISTENCIA_FLAG",
        "Valida a flag técnica flag_taxa_alfabetizacao_valida",
        fails=_flag_down("flag_taxa_alfabetizacao_valida"),
    ),
    CheckSpec(
        "alunos", "duplicate_key_ano_municipio_escola_aluno", "DUPLICIDADE",
        "Valida duplicidade na chave ano + id_municipio + id_escola + id_aluno",
        unique=("ano", "id_municipio", "id_escola", "id_aluno"),
    ),
    CheckSpec(
        "alunos", "missing_id_aluno", "VALORES_AUSENTES",
        "Valida se id_aluno está preenchido",
        fails=lambda: ~flags.filled("id_aluno"),
    ),
    CheckSpec(
        "alunos", "invalid_id_municipio", "VALIDADE",
        "Valida se id_municipio está preenchido e possui 7 caracteres",
        fails=_wrong_length("id_municipio", 7),
    ),
    CheckSpec(
        "alunos", "invalid_alfabetizado", "VALIDADE",
        "Valida se alfabetizado possui valor binário válido",
        fails=_not_binary("alfabetizado"),
    ),
    CheckSpec(
        "alunos", "invalid_presenca", "VALIDADE",
        "Valida se presenca possui valor binário válido",
        fails=_not_binary("presenca"),
    ),
    CheckSpec(
        "alunos", "invalid_preenchimento_caderno", "VALIDADE",
        "Valida se preenchimento_caderno possui valor binário válido",
        fails=_not_binary("preenchimento_caderno"),
    ),
    CheckSpec(
        "alunos", "invalid_proficiencia", "VALIDADE",
        "Valida se proficiencia é nula ou maior/igual a zero",
        fails=_negative("proficiencia"),
    ),
    CheckSpec(
        "alunos", "invalid_peso_aluno", "VALIDADE",
        "Valida se peso_aluno é nulo ou maior/igual a zero",
        fails=_negative("peso_aluno"),
    ),
    CheckSpec(
        "meta_alfabetizacao_brasil", "duplicate_key_ano_rede", "DUPLICIDADE",
        "Valida duplicidade na chave ano + rede",
        unique=("ano", "rede"),
    ),
    CheckSpec(
        "meta_alfabetizacao_brasil", "invalid_taxa_alfabetizacao", "VALIDADE",
        "Valida se taxa_alfabetizacao_pct está preenchida e entre 0 e 100",
        fails=_not_in_range(_RATE),
    ),
    CheckSpec(
        "meta_alfabetizacao_brasil", "invalid_percentual_participacao", "VALIDADE",
        "Valida se percentual_participacao_pct está preenchido e entre 0 e 100",
        fails=_not_in_range(_PARTICIPATION),
    ),
    CheckSpec(
        "meta_alfabetizacao_brasil", "invalid_meta_2030", "CONSISTENCIA",
        "Valida se meta_alfabetizacao_2030_pct está preenchida e igual a 80",
        fails=_not_goal(_TARGET_2030),
    ),
    CheckSpec(
        "meta_alfabetizacao_brasil", "invalid_metas_2025_2030", "CONSISTENCIA",
        "Valida a flag técnica flag_metas_2025_2030_validas",
        fails=_flag_down("flag_metas_2025_2030_validas"),
    ),
    CheckSpec(
        "meta_alfabetizacao_uf", "duplicate_key_ano_sigla_uf_rede", "DUPLICIDADE",
        "Valida duplicidade na chave ano + sigla_uf + rede",
        unique=("ano", "sigla_uf", "rede"),
    ),
    CheckSpec(
        "meta_alfabetizacao_uf", "invalid_sigla_uf", "VALIDADE",
        "Valida se sigla_uf está preenchida e possui 2 caracteres",
        fails=_wrong_length("sigla_uf", 2),
    ),
    CheckSpec(
        "meta_alfabetizacao_uf", "invalid_taxa_alfabetizacao", "VALIDADE",
        "Valida se taxa_alfabetizacao_pct está preenchida e entre 0 e 100",
        fails=_not_in_range(_RATE),
    ),
    CheckSpec(
        "meta_alfabetizacao_uf", "invalid_meta_2030", "CONSISTENCIA",
        "Valida se meta_alfabetizacao_2030_pct está preenchida e igual a 80",
        fails=_not_goal(_TARGET_2030),
    ),
    CheckSpec(
        "meta_alfabetizacao_uf", "registro_sem_indicadores", "COMPLETUDE",
        "Valida registros de UF sem indicadores/metas preenchidos",
        fails=_flag_down("flag_registro_com_indicadores"),
    ),
    CheckSpec(
        "meta_alfabetizacao_municipio", "duplicate_key_ano_id_municipio_rede", "DUPLICIDADE",
        "Valida duplicidade na chave ano + id_municipio + rede",
        unique=("ano", "id_municipio", "rede"),
    ),
    CheckSpec(
        "meta_alfabetizacao_municipio", "invalid_id_municipio", "VALIDADE",
        "Valida se id_municipio está preenchido e possui 7 caracteres",
        fails=_wrong_length("id_municipio", 7),
    ),
    CheckSpec(
        "meta_alfabetizacao_municipio", "invalid_taxa_alfabetizacao", "VALIDADE",
        "Valida se taxa_alfabetizacao_pct está preenchida e entre 0 e 100",
        fails=_not_in_range(_RATE),
    ),
    CheckSpec(
        "meta_alfabetizacao_municipio", "invalid_percentual_participacao", "VALIDADE",
        "Valida se percentual_participacao_pct está preenchido e entre 0 e 100",
        fails=_not_in_range(_PARTICIPATION),
    ),
    CheckSpec(
        "meta_alfabetizacao_municipio", "invalid_meta_2030", "CONSISTENCIA",
        "Valida se meta_alfabetizacao_2030_pct está preenchida e igual a 80",
        fails=_not_goal(_TARGET_2030),
    ),
    CheckSpec(
        "meta_alfabetizacao_municipio", "municipio_meta_sem_resultado_municipio", "CHAVE_RELACIONAMENTO",
        "Valida se todo id_municipio de meta_alfabetizacao_municipio existe em silver.municipio",
        reference=("id_municipio", "municipio"),
    ),
    CheckSpec(
        "alunos", "aluno_sem_resultado_municipio", "CHAVE_RELACIONAMENTO",
        "Valida se todo id_municipio de silver.alunos existe em silver.municipio",
        reference=("id_municipio", "municipio"),
    ),
    CheckSpec(
        "meta_alfabetizacao_uf", "uf_meta_sem_resultado_uf", "CHAVE_RELACIONAMENTO",
        "Valida se toda sigla_uf de meta_alfabetizacao_uf existe em silver.uf",
        reference=("sigla_uf", "uf"),
    ),
)


def row_checks_of(table: str) -> list[CheckSpec]:
    """The checks on single rows of one silver table, which a write can measure."""
    return [c for c in CHECKS if c.table == table and c.fails is not None]


def validation_results(
    silver: Mapping[str, DataFrame],
    executed_at: Column | None = None,
    measured: Mapping[str, Measures] | None = None,
) -> DataFrame:
    """All checks over the silver tables, given by name. Each is read several times: pass stored tables.

    ``measured`` holds numbers of row checks taken when a table was written; see ``run_checks``.
    """
    return run_checks(silver, CHECKS, executed_at, measured)
