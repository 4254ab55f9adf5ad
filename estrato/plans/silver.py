"""The six silver tables as data: casts, flags, business key and key name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame

from estrato.functions import flags
from estrato.functions.casts import DOUBLE, INT, TEXT, TRIMMED, UPPER_TRIMMED, Cast
from estrato.functions.measures import business_key
from estrato.operators.latest import latest_by_key
from estrato.operators.standardize import standardize
from estrato.sources.lineage import LINEAGE, stream_offset



def newest_first() -> tuple[str | Column, ...]:
    """What makes a row the newest of its key: arrival, then a stream's offset as a number, then the run."""
    return "_ingestion_timestamp_utc", stream_offset(), "_execution_id"



LEVELS = range(9)
TARGET_YEARS = range(2024, 2031)

LEVEL_COLUMNS = [f"proporcao_aluno_nivel_{n}_pct" for n in LEVELS]
TARGET_COLUMNS = {year: f"meta_alfabetizacao_{year}_pct" for year in TARGET_YEARS}
LATER_TARGETS = [name for year, name in TARGET_COLUMNS.items() if year > 2024]


@dataclass(frozen=True)
class SilverSpec:
    """How one silver table is made from its bronze table."""

    name: str
    casts: tuple[Cast, ...]
    key: tuple[str, ...]
    flags: Mapping[str, Callable[[], Column]]
    key_name: str
    names_rows: bool = False  # a whole key names one row of the source; see ``latest_by_key``


def typed(spec: SilverSpec, *bronze: DataFrame) -> DataFrame:
    """The rows of one or several bronze tables, brought to the same types and united."""
    return reduce(DataFrame.unionByName, [standardize(b, spec.casts, passthrough=LINEAGE) for b in bronze])


def newest(spec: SilverSpec, rows: DataFrame) -> DataFrame:
    """The newest row of each key among typed rows, with flags and the composite key.

    Flags and key depend on the row alone, so they are computed after deduplication: the shuffle carries
    neither, and rows that are dropped never pay for them.
    """
    return latest_by_key(rows, spec.key, newest_first(), names_rows=spec.names_rows).select(
        *[c.name for c in spec.casts],
        *[rule().alias(name) for name, rule in spec.flags.items()],
        business_key(*spec.key).alias(spec.key_name),
        *LINEAGE,
    )


def build(spec: SilverSpec, *bronze: DataFrame) -> DataFrame:
    """Standardise (a batch load and a stream, say), keep the newest row per key, then add flags and composite key."""
    return newest(spec, typed(spec, *bronze))


def _percent(name: str) -> Cast:
    return Cast(name, DOUBLE, f"{name}_pct")


_RATE = _percent("taxa_alfabetizacao")
_RESULT_MEASURES = (
    Cast("serie", INT),
    Cast("rede", INT),
    _RATE,
    Cast("media_portugues", DOUBLE),
    *[_percent(f"proporcao_aluno_nivel_{n}") for n in LEVELS],
)
_TARGETS = tuple(_percent(f"meta_alfabetizacao_{year}") for year in TARGET_YEARS)
_PARTICIPATION = _percent("percentual_participacao")


def _percent_rule(name: str) -> Callable[[], Column]:
    return lambda: flags.in_range(name, 0, 100)


_STATE_FLAG = {"flag_sigla_uf_valida": lambda: flags.length_is("sigla_uf", 2)}
_PLACE_FLAG = {"flag_id_municipio_valido": lambda: flags.length_is("id_municipio", 7)}
_RATE_FLAG = {"flag_taxa_alfabetizacao_valida": _percent_rule(_RATE.name)}
_LEVELS_FLAG = {"flag_possui_distribuicao_niveis": lambda: flags.any_filled(LEVEL_COLUMNS)}
_PARTICIPATION_FLAG = {"flag_percentual_participacao_valido": _percent_rule(_PARTICIPATION.name)}
_TARGET_FLAGS = {
    "flag_meta_2024_valida": _percent_rule(TARGET_COLUMNS[2024]),
    "flag_metas_2025_2030_validas": lambda: flags.all_in_range(LATER_TARGETS, 0, 100),
}

UF = SilverSpec(
    name="uf",
    casts=(Cast("ano", INT), Cast("sigla_uf", UPPER_TRIMMED), *_RESULT_MEASURES),
    key=("ano", "sigla_uf", "serie", "rede"),
    flags={**_STATE_FLAG, **_RATE_FLAG, **_LEVELS_FLAG},
    key_name="chave_uf_ano_serie_rede",
)

MUNICIPIO = SilverSpec(
    name="municipio",
    casts=(Cast("ano", INT), Cast("id_municipio", TEXT), *_RESULT_MEASURES),
    key=("ano", "id_municipio", "serie", "rede"),
    flags={**_PLACE_FLAG, **_RATE_FLAG, **_LEVELS_FLAG},
    key_name="chave_municipio_ano_serie_rede",
)

ALUNOS = SilverSpec(
    name="alunos",
    casts=(
        Cast("ano", INT),
        Cast("id_municipio", TEXT),
        Cast("id_escola", TEXT),
        Cast("id_aluno", TEXT),
        Cast("caderno", INT),
        Cast("serie", INT),
        Cast("rede", INT),
        Cast("presenca", INT),
        Cast("preenchimento_caderno", INT),
        Cast("alfabetizado", INT),
        Cast("proficiencia", DOUBLE),
        Cast("peso_aluno", DOUBLE),
    ),
    key=("ano", "id_municipio", "id_escola", "id_aluno"),
    flags={
        **_PLACE_FLAG,
        "flag_id_aluno_preenchido": lambda: flags.filled("id_aluno"),
        "flag_presenca_valida": lambda: flags.in_set("presenca", (0, 1)),
        "flag_preenchimento_caderno_valido": lambda: flags.in_set("preenchimento_caderno", (0, 1)),
        "flag_alfabetizado_valido": lambda: flags.in_set("alfabetizado", (0, 1)),
        "flag_proficiencia_valida": lambda: flags.null_or_at_least("proficiencia", 0),
        "flag_peso_aluno_valido": lambda: flags.null_or_at_least("peso_aluno", 0),
    },
    key_name="chave_aluno_ano_municipio_escola",
    names_rows=True,
)

META_UF = SilverSpec(
    name="meta_alfabetizacao_uf",
    casts=(Cast("ano", INT), Cast("sigla_uf", UPPER_TRIMMED), Cast("rede", TRIMMED), _RATE, *_TARGETS, _PARTICIPATION),
    key=("ano", "sigla_uf", "rede"),
    flags={
        **_STATE_FLAG,
        **_RATE_FLAG,
        **_PARTICIPATION_FLAG,
        **_TARGET_FLAGS,
        "flag_registro_com_indicadores": lambda: flags.any_filled(
            [_RATE.name, *TARGET_COLUMNS.values(), _PARTICIPATION.name]
        ),
    },
    key_name="chave_meta_uf_ano_rede",
)

META_MUNICIPIO = SilverSpec(
    name="meta_alfabetizacao_municipio",
    casts=(
        Cast("ano", INT),
        Cast("id_municipio", TEXT),
        Cast("rede", TRIMMED),
        _RATE,
        *_TARGETS,
        Cast("nivel_alfabetizacao", INT),
        _PARTICIPATION,
    ),
    key=("ano", "id_municipio", "rede"),
    flags={
        **_PLACE_FLAG,
        **_RATE_FLAG,
        **_PARTICIPATION_FLAG,
        "flag_nivel_alfabetizacao_valido": lambda: flags.in_range("nivel_alfabetizacao", 0, 5),
        **_TARGET_FLAGS,
    },
    key_name="chave_meta_municipio_ano_rede",
)

META_BRASIL = SilverSpec(
    name="meta_alfabetizacao_brasil",
    casts=(Cast("ano", INT), Cast("rede", TRIMMED), _RATE, *_TARGETS, _PARTICIPATION),
    key=("ano", "rede"),
    flags={**_RATE_FLAG, **_PARTICIPATION_FLAG, **_TARGET_FLAGS},
    key_name="chave_meta_brasil_ano_rede",
)

SILVER = (UF, MUNICIPIO, ALUNOS, META_UF, META_MUNICIPIO, META_BRASIL)
