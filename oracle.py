"""DuckDB statements that answer each registered query, written against the query's meaning, not its Spark plan."""

from __future__ import annotations

from typing import NamedTuple

from estrato.plans.starschema import BRONZE_SQL, EVENTS_SQL, RESENT


class Check(NamedTuple):
    table: str
    name: str
    kind: str
    description: str


# Fixed values, stated here on their own: the 36 checks, and the 27 states with code, acronym and region.
CHECKS = [Check(*row) for row in (
    ("uf", "duplicate_key_ano_sigla_uf_serie_rede", "DUPLICIDADE",
     "Valida duplicidade na chave ano + sigla_uf + serie + rede"),
    ("uf", "invalid_sigla_uf", "VALIDADE",
     "Valida se sigla_uf está preenchida e possui 2 caracteres"),
    ("uf", "invalid_taxa_alfabetizacao", "VALIDADE",
     "Valida se taxa_alfabetizacao_pct está preenchida e entre 0 e 100"),
    ("uf", "invalid_quality_flag_sigla_uf", "CONSISTENCIA_FLAG",
     "Valida a flag técnica flag_sigla_uf_valida"),
    ("uf", "invalid_quality_flag_taxa_alfabetizacao", "CONSISTENCIA_FLAG",
     "Valida a flag técnica flag_taxa_alfabetizacao_valida"),
    ("municipio", "duplicate_key_ano_id_municipio_serie_rede", "DUPLICIDADE",
     "Valida duplicidade na chave ano + id_municipio + serie + rede"),
    ("municipio", "invalid_id_municipio", "VALIDADE",
     "Valida se id_municipio está preenchido e possui 7 caracteres"),
    ("municipio", "invalid_taxa_alfabetizacao", "VALIDADE",
     "Valida se taxa_alfabetizacao_pct está preenchida e entre 0 e 100"),
    ("municipio", "invalid_quality_flag_id_municipio", "CONSISTENCIA_FLAG",
     "Valida a flag técnica flag_id_municipio_valido"),
    ("municipio", "invalid_quality_flag_taxa_alfabetizacao", "CONSISTENCIA_FLAG",
     "Valida a flag técnica flag_taxa_alfabetizacao_valida"),
    ("alunos", "duplicate_key_ano_municipio_escola_aluno", "DUPLICIDADE",
     "Valida duplicidade na chave ano + id_municipio + id_escola + id_aluno"),
    ("alunos", "missing_id_aluno", "VALORES_AUSENTES",
     "Valida se id_aluno está preenchido"),
    ("alunos", "invalid_id_municipio", "VALIDADE",
     "Valida se id_municipio está preenchido e possui 7 caracteres"),
    ("alunos", "invalid_alfabetizado", "VALIDADE",
     "Valida se alfabetizado possui valor binário válido"),
    ("alunos", "invalid_presenca", "VALIDADE",
     "Valida se presenca possui valor binário válido"),
    ("alunos", "invalid_preenchimento_caderno", "VALIDADE",
     "Valida se preenchimento_caderno possui valor binário válido"),
    ("alunos", "invalid_proficiencia", "VALIDADE",
     "Valida se proficiencia é nula ou maior/igual a zero"),
    ("alunos", "invalid_peso_aluno", "VALIDADE",
     "Valida se peso_aluno é nulo ou maior/igual a zero"),
    ("meta_alfabetizacao_brasil", "duplicate_key_ano_rede", "DUPLICIDADE",
     "Valida duplicidade na chave ano + rede"),
    ("meta_alfabetizacao_brasil", "invalid_taxa_alfabetizacao", "VALIDADE",
     "Valida se taxa_alfabetizacao_pct está preenchida e entre 0 e 100"),
    ("meta_alfabetizacao_brasil", "invalid_percentual_participacao", "VALIDADE",
     "Valida se percentual_participacao_pct está preenchido e entre 0 e 100"),
    ("meta_alfabetizacao_brasil", "invalid_meta_2030", "CONSISTENCIA",
     "Valida se meta_alfabetizacao_2030_pct está preenchida e igual a 80"),
    ("meta_alfabetizacao_brasil", "invalid_metas_2025_2030", "CONSISTENCIA",
     "Valida a flag técnica flag_metas_2025_2030_validas"),
    ("meta_alfabetizacao_uf", "duplicate_key_ano_sigla_uf_rede", "DUPLICIDADE",
     "Valida duplicidade na chave ano + sigla_uf + rede"),
    ("meta_alfabetizacao_uf", "invalid_sigla_uf", "VALIDADE",
     "Valida se sigla_uf está preenchida e possui 2 caracteres"),
    ("meta_alfabetizacao_uf", "invalid_taxa_alfabetizacao", "VALIDADE",
     "Valida se taxa_alfabetizacao_pct está preenchida e entre 0 e 100"),
    ("meta_alfabetizacao_uf", "invalid_meta_2030", "CONSISTENCIA",
     "Valida se meta_alfabetizacao_2030_pct está preenchida e igual a 80"),
    ("meta_alfabetizacao_uf", "registro_sem_indicadores", "COMPLETUDE",
     "Valida registros de UF sem indicadores/metas preenchidos"),
    ("meta_alfabetizacao_municipio", "duplicate_key_ano_id_municipio_rede", "DUPLICIDADE",
     "Valida duplicidade na chave ano + id_municipio + rede"),
    ("meta_alfabetizacao_municipio", "invalid_id_municipio", "VALIDADE",
     "Valida se id_municipio está preenchido e possui 7 caracteres"),
    ("meta_alfabetizacao_municipio", "invalid_taxa_alfabetizacao", "VALIDADE",
     "Valida se taxa_alfabetizacao_pct está preenchida e entre 0 e 100"),
    ("meta_alfabetizacao_municipio", "invalid_percentual_participacao", "VALIDADE",
     "Valida se percentual_participacao_pct está preenchido e entre 0 e 100"),
    ("meta_alfabetizacao_municipio", "invalid_meta_2030", "CONSISTENCIA",
     "Valida se meta_alfabetizacao_2030_pct está preenchida e igual a 80"),
    ("meta_alfabetizacao_municipio", "municipio_meta_sem_resultado_municipio", "CHAVE_RELACIONAMENTO",
     "Valida se todo id_municipio de meta_alfabetizacao_municipio existe em silver.municipio"),
    ("alunos", "aluno_sem_resultado_municipio", "CHAVE_RELACIONAMENTO",
     "Valida se todo id_municipio de silver.alunos existe em silver.municipio"),
    ("meta_alfabetizacao_uf", "uf_meta_sem_resultado_uf", "CHAVE_RELACIONAMENTO",
     "Valida se toda sigla_uf de meta_alfabetizacao_uf existe em silver.uf"),
)]

STATES = (
    ("11", "RO", "Norte"),
    ("12", "AC", "Norte"),
    ("13", "AM", "Norte"),
    ("14", "RR", "Norte"),
    ("15", "PA", "Norte"),
    ("16", "AP", "Norte"),
    ("17", "TO", "Norte"),
    ("21", "MA", "Nordeste"),
    ("22", "PI", "Nordeste"),
    ("23", "CE", "Nordeste"),
    ("24", "RN", "Nordeste"),
    ("25", "PB", "Nordeste"),
    ("26", "PE", "Nordeste"),
    ("27", "AL", "Nordeste"),
    ("28", "SE", "Nordeste"),
    ("29", "BA", "Nordeste"),
    ("31", "MG", "Sudeste"),
    ("32", "ES", "Sudeste"),
    ("33", "RJ", "Sudeste"),
    ("35", "SP", "Sudeste"),
    ("41", "PR", "Sul"),
    ("42", "SC", "Sul"),
    ("43", "RS", "Sul"),
    ("50", "MS", "Centro-Oeste"),
    ("51", "MT", "Centro-Oeste"),
    ("52", "GO", "Centro-Oeste"),
    ("53", "DF", "Centro-Oeste"),
)

WHEN = "2024-05-01T09:30:00-03:00"
DAY = "2024-05-01"
RUN = "20240501T093000Z"

LINEAGE = (
    "_source_system, _source_name, _source_dataset_id, _source_table_id, "
    "_ingestion_timestamp_utc, _ingestion_date, _execution_id"
)
# Lineage columns that break ties after the two that say which row is newest.
REST_OF_LINEAGE = "_source_system, _source_name, _source_dataset_id, _source_table_id, _ingestion_date"

YEARS = range(2024, 2031)
LEVELS = [f"proporcao_aluno_nivel_{n}" for n in range(9)]
TARGETS = [f"meta_alfabetizacao_{y}" for y in YEARS]


def _int(name: str) -> tuple[str, str]:
    return f"TRY_CAST({name} AS INTEGER)", name


def _double(name: str, alias: str | None = None) -> tuple[str, str]:
    return f"TRY_CAST({name} AS DOUBLE)", alias or name


def _pct(name: str) -> tuple[str, str]:
    return _double(name, f"{name}_pct")


def _text(name: str) -> tuple[str, str]:
    return f"CAST({name} AS VARCHAR)", name


BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"
STATE = (f"upper(trim(sigla_uf, {BLANKS}))", "sigla_uf")
NETWORK_TEXT = (f"trim(rede, {BLANKS})", "rede")

RESULT = [_int("serie"), _int("rede"), _pct("taxa_alfabetizacao"), _double("media_portugues")]
RESULT += [_pct(name) for name in LEVELS]
TARGET_COLUMNS = [_pct(name) for name in TARGETS]

COLUMNS = {
    "uf": [_int("ano"), STATE, *RESULT],
    "municipio": [_int("ano"), _text("id_municipio"), *RESULT],
    "alunos": [
        _int("ano"), _text("id_municipio"), _text("id_escola"), _text("id_aluno"),
        *[_int(c) for c in ("caderno", "serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado")],
        _double("proficiencia"), _double("peso_aluno"),
    ],
    "meta_alfabetizacao_uf": [
        _int("ano"), STATE, NETWORK_TEXT, _pct("taxa_alfabetizacao"), *TARGET_COLUMNS, _pct("percentual_participacao"),
    ],
    "meta_alfabetizacao_municipio": [
        _int("ano"), _text("id_municipio"), NETWORK_TEXT, _pct("taxa_alfabetizacao"), *TARGET_COLUMNS,
        _int("nivel_alfabetizacao"), _pct("percentual_participacao"),
    ],
    "meta_alfabetizacao_brasil": [
        _int("ano"), NETWORK_TEXT, _pct("taxa_alfabetizacao"), *TARGET_COLUMNS, _pct("percentual_participacao"),
    ],
}

KEYS = {
    "uf": ["ano", "sigla_uf", "serie", "rede"],
    "municipio": ["ano", "id_municipio", "serie", "rede"],
    "alunos": ["ano", "id_municipio", "id_escola", "id_aluno"],
    "meta_alfabetizacao_uf": ["ano", "sigla_uf", "rede"],
    "meta_alfabetizacao_municipio": ["ano", "id_municipio", "rede"],
    "meta_alfabetizacao_brasil": ["ano", "rede"],
}

KEY_NAMES = {
    "uf": "chave_uf_ano_serie_rede",
    "municipio": "chave_municipio_ano_serie_rede",
    "alunos": "chave_aluno_ano_municipio_escola",
    "meta_alfabetizacao_uf": "chave_meta_uf_ano_rede",
    "meta_alfabetizacao_municipio": "chave_meta_municipio_ano_rede",
    "meta_alfabetizacao_brasil": "chave_meta_brasil_ano_rede",
}


def _sure(condition: str) -> str:
    return f"coalesce({condition}, false)"


def _within(name: str, high: int = 100) -> str:
    return _sure(f"{name} BETWEEN 0 AND {high}")


STATE_OK = ("flag_sigla_uf_valida", _sure("length(sigla_uf) = 2"))
PLACE_OK = ("flag_id_municipio_valido", _sure("length(id_municipio) = 7"))
RATE_OK = ("flag_taxa_alfabetizacao_valida", _within("taxa_alfabetizacao_pct"))
LEVELS_OK = (
    "flag_possui_distribuicao_niveis", f"coalesce({', '.join(f'{c}_pct' for c in LEVELS)}) IS NOT NULL",
)
PART_OK = ("flag_percentual_participacao_valido", _within("percentual_participacao_pct"))
FIRST_TARGET_OK = ("flag_meta_2024_valida", _within(f"{TARGETS[0]}_pct"))
LATER_TARGETS_OK = (
    "flag_metas_2025_2030_validas", " AND ".join(_within(f"{c}_pct") for c in TARGETS[1:]),
)
ANY_INDICATOR = (
    "flag_registro_com_indicadores",
    f"coalesce(taxa_alfabetizacao_pct, {', '.join(f'{c}_pct' for c in TARGETS)}, percentual_participacao_pct) IS NOT NULL",
)

FLAGS = {
    "uf": [STATE_OK, RATE_OK, LEVELS_OK],
    "municipio": [PLACE_OK, RATE_OK, LEVELS_OK],
    "alunos": [
        PLACE_OK,
        ("flag_id_aluno_preenchido", "id_aluno IS NOT NULL"),
        ("flag_presenca_valida", _within("presenca", 1)),
        ("flag_preenchimento_caderno_valido", _within("preenchimento_caderno", 1)),
        ("flag_alfabetizado_valido", _within("alfabetizado", 1)),
        ("flag_proficiencia_valida", "coalesce(proficiencia, 0) >= 0"),
        ("flag_peso_aluno_valido", "coalesce(peso_aluno, 0) >= 0"),
    ],
    "meta_alfabetizacao_uf": [STATE_OK, RATE_OK, PART_OK, FIRST_TARGET_OK, LATER_TARGETS_OK, ANY_INDICATOR],
    "meta_alfabetizacao_municipio": [
        PLACE_OK, RATE_OK, PART_OK,
        ("flag_nivel_alfabetizacao_valido", _within("nivel_alfabetizacao", 5)),
        FIRST_TARGET_OK, LATER_TARGETS_OK,
    ],
    "meta_alfabetizacao_brasil": [RATE_OK, PART_OK, FIRST_TARGET_OK, LATER_TARGETS_OK],
}


def _names(table: str) -> list[str]:
    return [alias for _, alias in COLUMNS[table]]


def _typed(table: str, source: str, extra: str = "") -> str:
    columns = ", ".join(f"{expr} AS {alias}" for expr, alias in COLUMNS[table])
    return f"SELECT {columns}, {LINEAGE}{extra} FROM {source}"


BY_RUN = ("_ingestion_timestamp_utc DESC NULLS LAST", "_execution_id DESC NULLS LAST")
# Events arrive by the broker's clock, those of one instant by their number; columns that only the oracle has.
BY_ARRIVAL = ("arrived DESC", "arrived_offset DESC")
BY_BOTH = ("_ingestion_timestamp_utc DESC NULLS LAST", "arrived_offset DESC NULLS LAST", "_execution_id DESC NULLS LAST")


def _newest(table: str, source: str, newest_first: tuple[str, ...] = BY_RUN) -> str:
    rest = [c for c in _names(table) if c not in KEYS[table]] + REST_OF_LINEAGE.split(", ")
    order = list(newest_first)
    order += [f"{c} ASC NULLS LAST" for c in rest]
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {', '.join(KEYS[table])} ORDER BY {', '.join(order)}) = 1"
    )


def _joined_key(parts: list[str]) -> str:
    return " || '_' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)


def _with_flags(table: str, source: str) -> str:
    flag_list = ", ".join(f"{rule} AS {name}" for name, rule in FLAGS[table])
    return (
        f"SELECT {', '.join(_names(table))}, {flag_list}, {_joined_key(KEYS[table])} AS {KEY_NAMES[table]}, {LINEAGE} "
        f"FROM {source}"
    )


STATES_SQL = (
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{code}', '{acronym}', '{region}')" for code, acronym, region in STATES)
    + ") AS s(codigo_uf, sigla_uf, regiao)"
)

VALID_PLACES = "SELECT * FROM silver_municipio WHERE flag_id_municipio_valido AND flag_taxa_alfabetizacao_valida"

ROLLUP = """
    SELECT ano, id_municipio, serie, rede,
        count(*) AS qtd_alunos_amostra,
        count(*) FILTER (WHERE alfabetizado = 1) AS qtd_alunos_alfabetizados_amostra,
        count(*) FILTER (WHERE presenca = 1) AS qtd_alunos_presentes_amostra,
        avg(proficiencia) AS media_proficiencia_alunos_amostra,
        sum(peso_aluno) AS soma_peso_alunos_amostra
    FROM silver_alunos
    WHERE flag_id_municipio_valido AND flag_id_aluno_preenchido
    GROUP BY ALL"""


def _exact_pct(part: str, whole: str, digits: int) -> str:
    """100 * part / whole, half up, in whole numbers."""
    scale = 10**digits
    return (
        f"CASE WHEN {whole} > 0 THEN (CAST({part} AS HUGEINT) * {200 * scale} + {whole}) // (2 * {whole}) / {scale}.0::DOUBLE END"
    )


def _year_target(year: str, prefix: str = "") -> str:
    picks = " ".join(f"WHEN {y} THEN {prefix}meta_alfabetizacao_{y}_pct" for y in YEARS)
    return f"CASE {year} {picks} END"


INDICADOR = f"""
    SELECT m.ano, m.id_municipio, left(m.id_municipio, 2) AS codigo_uf, s.sigla_uf, s.regiao, m.serie, m.rede,
        m.taxa_alfabetizacao_pct, m.media_portugues,
        a.qtd_alunos_amostra, a.qtd_alunos_alfabetizados_amostra, a.qtd_alunos_presentes_amostra,
        {_exact_pct("a.qtd_alunos_alfabetizados_amostra", "a.qtd_alunos_amostra", 2)}
            AS taxa_alfabetizacao_alunos_amostra_pct,
        {_exact_pct("a.qtd_alunos_presentes_amostra", "a.qtd_alunos_amostra", 2)} AS taxa_presenca_alunos_amostra_pct,
        a.media_proficiencia_alunos_amostra, a.soma_peso_alunos_amostra, m.flag_possui_distribuicao_niveis,
        if(m.taxa_alfabetizacao_pct >= 80, 'ACIMA_OU_IGUAL_META_2030', 'ABAIXO_META_2030') AS status_meta_2030,
        80.0::DOUBLE AS meta_nacional_2030_pct,
        round(m.taxa_alfabetizacao_pct - 80, 2) AS diferenca_meta_2030_pp,
        {_joined_key(["m.ano", "m.id_municipio", "m.serie", "m.rede"])} AS chave_gold_indicador_municipio,
        m._ingestion_date, m._execution_id
    FROM ({VALID_PLACES}) AS m
    LEFT JOIN states AS s ON s.codigo_uf = left(m.id_municipio, 2)
    LEFT JOIN rollup_alunos AS a USING (ano, id_municipio, serie, rede)"""

METAS = f"""
    SELECT r.ano, r.id_municipio, left(r.id_municipio, 2) AS codigo_uf, s.sigla_uf, s.regiao, r.serie,
        r.rede AS rede_resultado, t.rede AS rede_meta,
        r.taxa_alfabetizacao_pct AS resultado_alfabetizacao_pct, r.media_portugues,
        {", ".join(f"t.{c}_pct" for c in TARGETS)},
        {_year_target("r.ano", "t.")} AS meta_ano_resultado_pct,
        round(r.taxa_alfabetizacao_pct - {_year_target("r.ano", "t.")}, 2) AS diferenca_meta_ano_pp,
        round(r.taxa_alfabetizacao_pct - t.meta_alfabetizacao_2030_pct, 2) AS diferenca_meta_2030_pp,
        if(r.ano = 2023, 'SEM_META_ANUAL', if({_year_target("r.ano", "t.")} IS NULL, 'META_NAO_DISPONIVEL',
            if(r.taxa_alfabetizacao_pct >= {_year_target("r.ano", "t.")}, 'ATINGIU_META_ANUAL', 'ABAIXO_META_ANUAL')))
            AS status_meta_ano,
        if(r.taxa_alfabetizacao_pct >= t.meta_alfabetizacao_2030_pct, 'ATINGIU_META_2030', 'ABAIXO_META_2030')
            AS status_meta_2030,
        if(r.taxa_alfabetizacao_pct < 50, 'ALTA', if(r.taxa_alfabetizacao_pct < 70, 'MEDIA', 'BAIXA'))
            || '_PRIORIDADE' AS faixa_prioridade_intervencao,
        t.nivel_alfabetizacao, t.percentual_participacao_pct,
        {_joined_key(["r.ano", "r.id_municipio", "r.serie", "r.rede"])} AS chave_gold_metas_vs_resultados_municipio,
        r._ingestion_date, r._execution_id
    FROM ({VALID_PLACES} AND rede = 3) AS r
    LEFT JOIN states AS s ON s.codigo_uf = left(r.id_municipio, 2)
    LEFT JOIN (SELECT * FROM silver_meta_alfabetizacao_municipio WHERE flag_id_municipio_valido) AS t
        ON t.ano = r.ano AND t.id_municipio = r.id_municipio"""

EVOLUCAO = f"""
    SELECT ano, sigla_uf, regiao, serie, rede_resultado, rede_meta,
        x AS resultado_alfabetizacao_uf_pct,
        px AS resultado_alfabetizacao_uf_ano_anterior_pct,
        round(x - px, 2) AS variacao_alfabetizacao_uf_pp,
        bx AS taxa_alfabetizacao_brasil_pct,
        round(x - bx, 2) AS diferenca_brasil_pp,
        goal AS meta_ano_resultado_uf_pct,
        round(x - goal, 2) AS diferenca_meta_ano_pp,
        meta_alfabetizacao_2030_pct,
        round(x - meta_alfabetizacao_2030_pct, 2) AS diferenca_meta_2030_pp,
        if(goal IS NULL, 'SEM_META_ANUAL', if(x >= goal, 'ATINGIU_META_ANUAL', 'ABAIXO_META_ANUAL')) AS status_meta_ano,
        if(x >= meta_alfabetizacao_2030_pct, 'ATINGIU_META_2030', 'ABAIXO_META_2030') AS status_meta_2030,
        ranking_uf_no_ano,
        percentual_participacao_uf_pct, percentual_participacao_brasil_pct,
        flag_possui_distribuicao_niveis, flag_registro_com_indicadores,
        {_joined_key(["ano", "sigla_uf", "rede_resultado"])} AS chave_gold_evolucao_alfabetizacao_uf,
        _ingestion_date, _execution_id
    FROM (
        SELECT *,
            lag(x) OVER (PARTITION BY sigla_uf, rede_resultado ORDER BY ano NULLS LAST, serie NULLS FIRST,
                rede_meta NULLS FIRST, rede_brasil NULLS FIRST) AS px,
            rank() OVER (PARTITION BY ano ORDER BY x DESC NULLS LAST) AS ranking_uf_no_ano
        FROM (
            SELECT r.ano, r.sigla_uf, s.regiao, r.serie, r.rede AS rede_resultado, t.rede AS rede_meta,
                b.rede AS rede_brasil, r.taxa_alfabetizacao_pct AS x, b.taxa_alfabetizacao_pct AS bx,
                {_year_target("r.ano", "t.")} AS goal, t.meta_alfabetizacao_2030_pct,
                t.percentual_participacao_pct AS percentual_participacao_uf_pct,
                b.percentual_participacao_pct AS percentual_participacao_brasil_pct,
                r.flag_possui_distribuicao_niveis, t.flag_registro_com_indicadores, r._ingestion_date, r._execution_id
            FROM silver_uf AS r
            LEFT JOIN states AS s ON s.sigla_uf = r.sigla_uf
            LEFT JOIN (SELECT * FROM silver_meta_alfabetizacao_uf WHERE flag_sigla_uf_valida) AS t
                ON t.ano = r.ano AND t.sigla_uf = r.sigla_uf
            LEFT JOIN silver_meta_alfabetizacao_brasil AS b ON b.ano = r.ano
            WHERE r.rede = 5 AND r.flag_sigla_uf_valida AND r.flag_taxa_alfabetizacao_valida
        )
    )"""

# What makes a row fail, by check; key and reference checks are written out below.
ROW_FAILURES = {
    "invalid_sigla_uf": "sigla_uf IS NULL OR length(sigla_uf) != 2",
    "invalid_taxa_alfabetizacao": "taxa_alfabetizacao_pct IS NULL OR taxa_alfabetizacao_pct < 0 OR taxa_alfabetizacao_pct > 100",
    "invalid_quality_flag_sigla_uf": "NOT flag_sigla_uf_valida",
    "invalid_quality_flag_taxa_alfabetizacao": "NOT flag_taxa_alfabetizacao_valida",
    "invalid_id_municipio": "id_municipio IS NULL OR length(id_municipio) != 7",
    "invalid_quality_flag_id_municipio": "NOT flag_id_municipio_valido",
    "missing_id_aluno": "id_aluno IS NULL",
    "invalid_alfabetizado": "coalesce(alfabetizado, -1) NOT IN (0, 1)",
    "invalid_presenca": "coalesce(presenca, -1) NOT IN (0, 1)",
    "invalid_preenchimento_caderno": "coalesce(preenchimento_caderno, -1) NOT IN (0, 1)",
    "invalid_proficiencia": "proficiencia < 0",
    "invalid_peso_aluno": "peso_aluno < 0",
    "invalid_percentual_participacao": "percentual_participacao_pct IS NULL OR percentual_participacao_pct < 0 OR percentual_participacao_pct > 100",
    "invalid_meta_2030": "meta_alfabetizacao_2030_pct IS DISTINCT FROM 80",
    "invalid_metas_2025_2030": "NOT flag_metas_2025_2030_validas",
    "registro_sem_indicadores": "NOT flag_registro_com_indicadores",
}

REFERENCE_FAILURES = {
    "municipio_meta_sem_resultado_municipio": ("id_municipio", "municipio"),
    "aluno_sem_resultado_municipio": ("id_municipio", "municipio"),
    "uf_meta_sem_resultado_uf": ("sigla_uf", "uf"),
}


def _duplicates(source: str, keys: list[str]) -> str:
    return (
        f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_records, count(*) FILTER (WHERE n > 1) AS failed_records "
        f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {', '.join(keys)})"
    )


def _orphans(child: str, parent: str, key: str) -> str:
    return (
        f"SELECT count(*) AS total_records, count(*) FILTER (WHERE NOT EXISTS "
        f"(SELECT 1 FROM {parent} AS p WHERE p.{key} = c.{key})) AS failed_records FROM {child} AS c"
    )


def _check(table: str, name: str, kind: str, description: str) -> str:
    source = f"silver_{table}"
    if name.startswith("duplicate_key"):
        counted = _duplicates(source, KEYS[table])
    elif name in REFERENCE_FAILURES:
        key, parent = REFERENCE_FAILURES[name]
        counted = _orphans(source, f"silver_{parent}", key)
    else:
        counted = (
            f"SELECT count(*) AS total_records, "
            f"CAST(sum(CASE WHEN {ROW_FAILURES[name]} THEN 1 ELSE 0 END) AS BIGINT) AS failed_records FROM {source}"
        )
    return (
        f"SELECT 'silver' AS layer_name, '{table}' AS table_name, '{name}' AS check_name, '{kind}' AS check_type, "
        f"'{description}' AS check_description, total_records, failed_records FROM ({counted})"
    )


def _results(checks: str) -> str:
    return f"""
    SELECT layer_name, table_name, check_name, check_type,
        if(failed_records = 0, 'PASS', 'FAIL') AS status, total_records, failed_records,
        CASE WHEN total_records > 0 THEN {_exact_pct("failed_records", "total_records", 4)} ELSE 0.0::DOUBLE END
            AS failed_pct,
        check_description, '{WHEN}' AS execution_timestamp_utc
    FROM ({checks})"""


QUALITY = _results(" UNION ALL ".join(_check(c.table, c.name, c.kind, c.description) for c in CHECKS))

REQUIRED = ["ano", "sigla_uf", "serie", "rede", "taxa_alfabetizacao", "media_portugues"]
EVENT_TYPES = {
    "ano": "INTEGER", "sigla_uf": "VARCHAR", "serie": "INTEGER", "rede": "INTEGER",
    "taxa_alfabetizacao": "DOUBLE", "media_portugues": "DOUBLE", LEVELS[0]: "INTEGER",
    **{name: "DOUBLE" for name in LEVELS[1:]},
}


def _event_field(name: str, kind: str) -> str:
    """Numbers cut to integers toward zero; text must spell the whole target type."""
    text = f"json_extract_string(doc, '$.{name}')"
    if kind == "VARCHAR":
        return text
    if kind == "DOUBLE":
        return f"TRY_CAST({text} AS DOUBLE)"
    return (
        f"CASE WHEN json_type(doc, '$.{name}') = 'VARCHAR' THEN "
        f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+') THEN TRY_CAST({text} AS INTEGER) END "
        f"ELSE TRY_CAST(trunc(TRY_CAST({text} AS DOUBLE)) AS INTEGER) END"
    )


_GIVEN = {name: f"json_extract_string(doc, '$.{name}') IS NOT NULL" for name in EVENT_TYPES}
PARSED_EVENTS = f"""
    SELECT topic, partition, "offset", "timestamp", {", ".join(EVENT_TYPES)},
        CASE WHEN doc IS NULL THEN 'decode'
             WHEN json_type(doc) != 'OBJECT' OR NOT ({" AND ".join(_GIVEN[n] for n in REQUIRED)}) THEN 'required'
             WHEN {" OR ".join(f"({_GIVEN[n]} AND {n} IS NULL)" for n in EVENT_TYPES)} THEN 'coercion'
        END AS reject_reason
    FROM (
        SELECT *, {", ".join(f"{_event_field(n, k)} AS {n}" for n, k in EVENT_TYPES.items())}
        FROM (
            SELECT topic, partition, "offset", "timestamp", CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS doc
            FROM broker_events
        )
    )"""

STREAM_BRONZE = f"""
    SELECT {", ".join(EVENT_TYPES)},
        'kafka_stream' AS _source_system, 'uf' AS _source_name,
        'br_inep_avaliacao_alfabetizacao' AS _source_dataset_id, 'uf' AS _source_table_id,
        strftime("timestamp" - INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '-03:00' AS _ingestion_timestamp_utc,
        strftime("timestamp" - INTERVAL 3 HOUR, '%Y-%m-%d') AS _ingestion_date,
        'stream_{RUN}_offset' || CAST("offset" AS VARCHAR) AS _execution_id,
        "timestamp" AS arrived, "offset" AS arrived_offset
    FROM parsed_events WHERE reject_reason IS NULL"""


# All rows of lineitem, and those with flag R a second time.
DELIVERIES = """(
    SELECT *, 0 AS resent FROM lineitem UNION ALL SELECT *, 1 AS resent FROM lineitem WHERE l_returnflag = 'R')"""


def _for_duckdb(text: str) -> str:
    for name in ("lineitem", "events"):
        text = text.replace("{" + name + "}", name)
    return text.replace("{{", "{").replace("}}", "}")


def _ctes() -> dict[str, str]:
    """All named steps, each after the steps it reads."""
    steps: dict[str, str] = {"states": STATES_SQL}
    for table in COLUMNS:
        steps[f"bronze_{table}"] = _for_duckdb(BRONZE_SQL[table].replace(f"{{lineitem}}\n    {RESENT}", DELIVERIES))
        steps[f"typed_{table}"] = _typed(table, f"bronze_{table}")
        steps[f"newest_{table}"] = _newest(table, f"typed_{table}")
        steps[f"silver_{table}"] = _with_flags(table, f"newest_{table}")
    steps["rollup_alunos"] = ROLLUP
    steps["gold_indicador"] = INDICADOR
    steps["gold_metas"] = METAS
    steps["gold_evolucao"] = EVOLUCAO
    steps["broker_events"] = _for_duckdb(EVENTS_SQL)
    steps["parsed_events"] = PARSED_EVENTS
    steps["stream_bronze"] = STREAM_BRONZE
    steps["typed_stream"] = _typed("uf", "stream_bronze", ", arrived, arrived_offset")
    steps["newest_stream"] = _newest("uf", "typed_stream", BY_ARRIVAL)
    steps["silver_stream"] = _with_flags("uf", "newest_stream")
    steps["typed_hybrid"] = "SELECT * FROM typed_uf UNION ALL BY NAME SELECT * FROM typed_stream"
    steps["newest_hybrid"] = _newest("uf", "typed_hybrid", BY_BOTH)
    steps["silver_hybrid"] = _with_flags("uf", "newest_hybrid")
    return steps


STEPS = _ctes()


def _mentions(text: str) -> set[str]:
    words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split())
    return {name for name in STEPS if name in words}


def statement(final: str) -> str:
    """``final`` with the steps it needs, directly or through others, in front of it."""
    needed: set[str] = set()
    waiting = _mentions(final)
    while waiting:
        name = waiting.pop()
        if name not in needed:
            needed.add(name)
            waiting |= _mentions(STEPS[name]) - {name}
    parts = [f"{name} AS ({text})" for name, text in STEPS.items() if name in needed]
    return f"WITH {', '.join(parts)} {final}" if parts else final


def _batch_lineage(name: str, dataset: str, table: str) -> str:
    return (
        f"'base_dos_dados' AS _source_system, '{name}' AS _source_name, '{dataset}' AS _source_dataset_id, "
        f"'{table}' AS _source_table_id, '{WHEN}' AS _ingestion_timestamp_utc, '{DAY}' AS _ingestion_date, "
        f"'{RUN}' AS _execution_id"
    )


def statements() -> dict[str, str]:
    raw = {
        "safe_cast": "SELECT * FROM typed_alunos",
        "key_normalisation": "SELECT * FROM typed_meta_alfabetizacao_uf",
        "quality_flags": f"""
            SELECT {", ".join(KEYS["alunos"])}, {", ".join(f"{rule} AS {name}" for name, rule in FLAGS["alunos"])},
                _execution_id FROM typed_alunos""",
        "business_key": f"SELECT {_joined_key(KEYS['alunos'])} AS chave, _execution_id FROM typed_alunos",
        "keep_latest": "SELECT * FROM newest_alunos",
        **{f"silver_{table}": f"SELECT * FROM silver_{table}" for table in COLUMNS},
        "territory_lookup": f"""
            SELECT {KEY_NAMES["municipio"]}, id_municipio, left(id_municipio, 2) AS codigo_uf, sigla_uf, regiao
            FROM silver_municipio LEFT JOIN states ON codigo_uf = left(id_municipio, 2)""",
        "region_lookup": f"""
            SELECT u.{KEY_NAMES["uf"]}, u.sigla_uf, s.regiao FROM silver_uf AS u LEFT JOIN states AS s USING (sigla_uf)""",
        "sample_rollup": "SELECT * FROM rollup_alunos",
        "target_of_year": f"""
            SELECT {KEY_NAMES["meta_alfabetizacao_municipio"]}, ano, taxa_alfabetizacao_pct,
                {_year_target("ano")} AS meta_ano_pct,
                round(taxa_alfabetizacao_pct - {_year_target("ano")}, 2) AS diferenca_meta_ano_pp,
                if({_year_target("ano")} IS NULL, 'SEM_META_ANUAL', if(taxa_alfabetizacao_pct >= {_year_target("ano")},
                    'ATINGIU_META_ANUAL', 'ABAIXO_META_ANUAL')) AS status_meta_ano
            FROM silver_meta_alfabetizacao_municipio""",
        "priority_band": f"""
            SELECT {KEY_NAMES["municipio"]}, taxa_alfabetizacao_pct, CASE WHEN taxa_alfabetizacao_pct < 50
                THEN 'ALTA_PRIORIDADE' WHEN taxa_alfabetizacao_pct < 70 THEN 'MEDIA_PRIORIDADE'
                ELSE 'BAIXA_PRIORIDADE' END AS faixa FROM ({VALID_PLACES})""",
        "year_on_year": f"""
            SELECT ano, id_municipio, serie, rede, taxa_alfabetizacao_pct,
                lag(taxa_alfabetizacao_pct) OVER w AS taxa_anterior_pct,
                round(taxa_alfabetizacao_pct - lag(taxa_alfabetizacao_pct) OVER w, 2) AS variacao_pp
            FROM ({VALID_PLACES})
            WINDOW w AS (PARTITION BY id_municipio, rede ORDER BY ano NULLS LAST, serie NULLS FIRST)""",
        "year_rank": f"""
            SELECT ano, id_municipio, serie, rede, taxa_alfabetizacao_pct,
                rank() OVER (PARTITION BY ano ORDER BY taxa_alfabetizacao_pct DESC NULLS LAST) AS posicao
            FROM silver_municipio""",
        "gold_indicador_municipio": "SELECT * FROM gold_indicador",
        "gold_metas_vs_resultados_municipio": "SELECT * FROM gold_metas",
        "gold_evolucao_alfabetizacao_uf": "SELECT * FROM gold_evolucao",
        "duplicate_groups": _duplicates("typed_alunos", KEYS["alunos"]),
        "orphan_rows": _orphans("typed_alunos", "typed_municipio", "id_municipio"),
        "row_checks": " UNION ALL ".join(
            _check(c.table, c.name, c.kind, c.description)
            for c in CHECKS
            if c.table == "alunos" and c.name in ROW_FAILURES
        ),
        "quality_checks": QUALITY,
        "below_target": """
            SELECT ano, id_municipio, sigla_uf, regiao, serie, rede_meta, resultado_alfabetizacao_pct,
                meta_ano_resultado_pct, diferenca_meta_ano_pp, faixa_prioridade_intervencao
            FROM gold_metas WHERE status_meta_ano = 'ABAIXO_META_ANUAL'""",
        "best_evolving_states": """
            SELECT DISTINCT ano, sigla_uf, regiao, serie, resultado_alfabetizacao_uf_pct,
                resultado_alfabetizacao_uf_ano_anterior_pct, variacao_alfabetizacao_uf_pp
            FROM gold_evolucao WHERE variacao_alfabetizacao_uf_pp IS NOT NULL
            ORDER BY variacao_alfabetizacao_uf_pp DESC, ano, sigla_uf, serie, resultado_alfabetizacao_uf_pct,
                resultado_alfabetizacao_uf_ano_anterior_pct LIMIT 10""",
        "regional_inequality": """
            SELECT ano, regiao, count(*) AS qtd_resultados,
                (sum(CAST(round(x * 100) AS BIGINT)) * 200 + count(*)) // (2 * count(*)) / 10000.0::DOUBLE AS media_pct,
                min(x) AS menor_pct, max(x) AS maior_pct, round(max(x) - min(x), 2) AS amplitude_pp,
                round(stddev_samp(x), 4) AS desvio_padrao
            FROM (SELECT DISTINCT ano, regiao, sigla_uf, serie, resultado_alfabetizacao_uf_pct AS x FROM gold_evolucao)
            GROUP BY ano, regiao""",
        "event_parse_validate": "SELECT * FROM parsed_events",
        "event_rejects": """
            SELECT reject_reason, count(*) AS eventos FROM parsed_events WHERE reject_reason IS NOT NULL GROUP BY ALL""",
        "stream_lineage": "SELECT * EXCLUDE (arrived, arrived_offset) FROM stream_bronze",
        "stream_ingest_roundtrip": "SELECT * FROM silver_stream",
        "stream_mirror_roundtrip": f"SELECT {', '.join(EVENT_TYPES)} FROM parsed_events WHERE reject_reason IS NULL",
        "stream_redelivery": f"SELECT {', '.join(EVENT_TYPES)} FROM parsed_events WHERE reject_reason IS NULL",
        "stream_newest": "SELECT * FROM silver_stream",
        "batch_and_stream_silver": "SELECT * FROM silver_hybrid",
        "shared_bronze_silver": "SELECT * FROM silver_hybrid",
        "reject_roundtrip": """
            SELECT topic, partition, "offset", "timestamp", reject_reason
            FROM parsed_events WHERE reject_reason IS NOT NULL""",
        "catalog_roundtrip": "SELECT * FROM newest_meta_alfabetizacao_brasil",
        "catalog_by_date": "SELECT * FROM newest_meta_alfabetizacao_brasil",
        "incremental_silver": "SELECT * FROM silver_municipio",
        "incremental_report": """
            SELECT entrega, count(*) AS linhas, count(DISTINCT _ingestion_date) AS datas, count(*) AS linhas_lidas,
                count(DISTINCT _ingestion_date) AS datas_lidas, entrega = 1 AS completa
            FROM (SELECT _ingestion_date, CASE WHEN _ingestion_date < '1998' THEN 1 WHEN _ingestion_date < '2000' THEN 2
                ELSE 3 END AS entrega FROM bronze_municipio) GROUP BY entrega""",
        "step_statistics": " UNION ALL ".join(
            f"""SELECT '{t}' AS tabela, count(*) AS linhas_bronze, count(*) AS linhas_varridas,
                true AS com_bytes_varridos, true AS com_tempo, true AS bytes_conferem FROM bronze_{t}"""
            for t in COLUMNS
        ),
        "batch_lineage": f"SELECT *, {_batch_lineage('pedidos', 'vendas', 'orders')} FROM orders",
        "bronze_batch_ingest": " UNION ALL BY NAME ".join(
            f"SELECT *, {_batch_lineage(t, 'vendas', t)} FROM {t}" for t in ("customer", "supplier")
        ),
        "bronze_partitioned_roundtrip": """
            SELECT *, strftime(ts, '%Y-%m-%d') AS _ingestion_date FROM events""",
        "rebuild_all_layers": " UNION ALL ".join(
            f"SELECT '{layer}' AS camada, '{t}' AS tabela, {n} AS linhas, {n} AS linhas_informadas, true AS com_tempo{step}"
            for layer, t, n, step in (
                *[("silver", t, "count(*)", f" FROM silver_{t}") for t in COLUMNS],
                ("gold", "indicador_municipio", "count(*)", " FROM gold_indicador"),
                ("gold", "metas_vs_resultados_municipio", "count(*)", " FROM gold_metas"),
                ("gold", "evolucao_alfabetizacao_uf", "count(*)", " FROM gold_evolucao"),
                ("quality", "validation_results", "36::BIGINT", ""),
            )
        ),
        "stored_gold_metas": "SELECT * FROM gold_metas",
        "stored_gold_evolucao": "SELECT * FROM gold_evolucao",
        "stored_quality_results": f"SELECT * EXCLUDE (execution_timestamp_utc), true AS carimbo_recente FROM ({QUALITY})",
        "measured_quality_results": f"SELECT * EXCLUDE (execution_timestamp_utc) FROM ({QUALITY})",
        "dry_run": " UNION ALL ".join(
            f"SELECT '{t}' AS tabela, count(*) AS linhas_bronze, true AS so_planejada, false AS gravada FROM bronze_{t}"
            for t in COLUMNS
        ),
    }
    return {name: statement(text) for name, text in raw.items()}
