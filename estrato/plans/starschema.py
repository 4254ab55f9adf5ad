"""Bronze-shaped inputs derived from the star-schema tables, so every operator runs on data that grows.

Each input is one projection or aggregate in SQL that Spark and DuckDB both accept, over whole tables. Values are
text, as delivered by a raw source, and some are dirty on purpose: unparsable numbers, malformed and missing
ids, rates out of range, late re-deliveries of the same key. Rates are cut to two decimals in integer arithmetic
and sums run over exactly representable numbers, so results do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estrato.functions.territory import STATES

# 28 places: the 27 states, and one code that belongs to none.
_CODES = "".join(code for code, _, _ in STATES) + "99"
_ACRONYMS = "".join(acronym for _, acronym, _ in STATES)

_YEAR = "year(l_shipdate) + 28"
_PLACE_NO = "CAST(l_suppkey % 28 AS INT)"
_PLACE = f"substr('{_CODES}', {_PLACE_NO} * 2 + 1, 2) || lpad(CAST(l_suppkey % 100000 AS STRING), 5, '0')"
_NETWORK = "CASE WHEN l_linenumber <= 3 THEN '3' WHEN l_linenumber <= 5 THEN '2' ELSE '5' END"
_GRADE = "CASE WHEN l_quantity > 45 THEN '5' ELSE '2' END"
_ON_TARGET = "sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)"
_TOOK_PART = "sum(CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END)"


def _share(part: str, whole: str = "n") -> str:
    """100 * part / whole, half up to two decimals."""
    return f"(floor((20000 * {part} + {whole}) / (2 * {whole})) / 100e0)"


def _lineage(table: str, day: str, later: str = "0") -> str:
    """One delivery date per year; within it, the time of delivery follows the month and day of ``day``."""
    date = f"CAST(year({day}) AS STRING) || '-12-31'"
    hour = f"lpad(CAST(month({day}) + {later} AS STRING), 2, '0')"
    minute = f"lpad(CAST(day({day}) AS STRING), 2, '0')"
    return f"""
        'base_dos_dados' AS _source_system,
        '{table}' AS _source_name,
        'br_inep_avaliacao_alfabetizacao' AS _source_dataset_id,
        '{table}' AS _source_table_id,
        {date} || 'T' || {hour} || ':' || {minute} || ':00-03:00' AS _ingestion_timestamp_utc,
        {date} AS _ingestion_date,
        CAST(year({day}) AS STRING) || '1231T' || {hour} || {minute} || '00Z' AS _execution_id"""


# Rows with flag R are delivered twice; every row, whatever its flag, once at least.
RESENT = """JOIN (VALUES (0, 0), (1, 0), (1, 1)) AS deliveries (times, resent)
        ON CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END = times"""

_ALUNOS = f"""
    SELECT
        CASE WHEN l_quantity = 50 AND l_tax = 0.08 THEN 'n/d' ELSE CAST({_YEAR} AS STRING) END AS ano,
        CASE WHEN l_quantity = 1 AND l_tax = 0 THEN NULL
             WHEN l_quantity = 2 AND l_tax > 0.06 THEN substr({_PLACE}, 1, 6)
             ELSE {_PLACE} END AS id_municipio,
        '35' || lpad(CAST(l_suppkey % 1000 AS STRING), 6, '0') AS id_escola,
        CASE WHEN l_quantity = 25 AND l_returnflag = 'N' THEN NULL
             ELSE CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS id_aluno,
        CAST(l_linenumber AS STRING) AS caderno,
        {_GRADE} AS serie,
        {_NETWORK} AS rede,
        CASE WHEN l_returnflag = 'N' THEN '0' WHEN l_quantity = 7 THEN '2' ELSE '1' END AS presenca,
        CASE WHEN l_quantity = 8 THEN NULL WHEN l_linestatus = 'F' THEN '1' ELSE '0' END AS preenchimento_caderno,
        CASE WHEN l_quantity = 9 THEN 'x' WHEN l_quantity = 10 THEN '2'
             WHEN l_linestatus = 'F' THEN '1' ELSE '0' END AS alfabetizado,
        CASE WHEN l_quantity = 3 AND l_discount = 0 THEN '-1'
             WHEN l_quantity = 4 AND l_discount = 0 THEN 'abc'
             WHEN l_quantity = 5 AND l_discount = 0 THEN NULL
             ELSE CAST(floor(l_extendedprice) / 64e0 + resent AS STRING) END AS proficiencia,
        CASE WHEN l_quantity = 6 AND l_discount = 0 THEN '-0.5'
             ELSE CAST(round(l_discount * 100) / 8e0 AS STRING) END AS peso_aluno,
        {_lineage("alunos", "l_shipdate", "11 * resent")}
    FROM {{lineitem}}
    {RESENT}"""

_LEVEL_COUNTS = ",\n            ".join(
    f"sum(CASE WHEN floor((l_quantity - 1) / 6) = {n} THEN 1 ELSE 0 END) AS level_{n}" for n in range(9)
)
_LEVEL_SHARES = ",\n        ".join(
    f"CASE WHEN yr <= 2023 THEN NULL ELSE CAST({_share(f'level_{n}')} AS STRING) END AS proporcao_aluno_nivel_{n}"
    for n in range(9)
)

_MUNICIPIO = f"""
    SELECT
        CAST(yr AS STRING) AS ano,
        CASE WHEN n % 19 = 7 THEN NULL WHEN n % 19 = 8 THEN '0' || place ELSE place END AS id_municipio,
        grade AS serie,
        network AS rede,
        CASE WHEN n % 13 = 0 THEN 'abc' WHEN n % 17 = 5 THEN '101.5' WHEN n % 23 = 3 THEN NULL
             ELSE CAST({_share("good")} AS STRING) END AS taxa_alfabetizacao,
        CAST(price / (64e0 * n) AS STRING) AS media_portugues,
        {_LEVEL_SHARES},
        {_lineage("municipio", "last_day")}
    FROM (
        SELECT *, {_PLACE} AS place
        FROM (
            SELECT
                {_YEAR} AS yr,
                l_suppkey,
                {_GRADE} AS grade,
                {_NETWORK} AS network,
                l_returnflag AS delivery,
                count(*) AS n,
                {_ON_TARGET} AS good,
                sum(floor(l_extendedprice)) AS price,
                max(l_shipdate) AS last_day,
                {_LEVEL_COUNTS}
            FROM {{lineitem}}
            GROUP BY 1, 2, 3, 4, 5
        ) AS grouped
    ) AS placed"""

_UF = f"""
    SELECT
        CAST(yr AS STRING) AS ano,
        CASE WHEN place_no = 27 THEN 'SPX'
             WHEN delivery = 'A' THEN ' ' || lower(substr('{_ACRONYMS}', place_no * 2 + 1, 2)) || ' '
             ELSE substr('{_ACRONYMS}', place_no * 2 + 1, 2) END AS sigla_uf,
        '2' AS serie,
        network AS rede,
        CASE WHEN place_no = 3 AND yr = 2025 THEN NULL
             WHEN place_no = 4 AND yr = 2026 THEN '101.5'
             WHEN place_no = 6 AND yr = 2024 THEN '-1'
             ELSE CAST({_share("good")} AS STRING) END AS taxa_alfabetizacao,
        CAST(price / (64e0 * n) AS STRING) AS media_portugues,
        {_LEVEL_SHARES},
        {_lineage("uf", "last_day")}
    FROM (
        SELECT
            {_YEAR} AS yr,
            {_PLACE_NO} AS place_no,
            {_NETWORK} AS network,
            l_returnflag AS delivery,
            count(*) AS n,
            {_ON_TARGET} AS good,
            sum(floor(l_extendedprice)) AS price,
            max(l_shipdate) AS last_day,
            {_LEVEL_COUNTS}
        FROM {{lineitem}}
        GROUP BY 1, 2, 3, 4
    ) AS grouped"""


def _targets(no_target: str, off_goal: str) -> str:
    """Target columns 2024 to 2030: three points more each year from the group's rate, 80 in the last."""
    columns = [
        f"CASE WHEN {no_target} THEN NULL ELSE CAST(least(100e0, rate + {3 * (year - 2023)}e0) AS STRING) END"
        f" AS meta_alfabetizacao_{year}"
        for year in range(2024, 2030)
    ]
    columns.append(
        f"CASE WHEN {no_target} THEN NULL WHEN {off_goal} THEN CAST(rate + 21e0 AS STRING) ELSE '80' END"
        " AS meta_alfabetizacao_2030"
    )
    return ",\n        ".join(columns)


_META_UF = f"""
    SELECT
        CAST(yr AS STRING) AS ano,
        CASE WHEN place_no = 27 THEN 'SPX' ELSE substr('{_ACRONYMS}', place_no * 2 + 1, 2) END AS sigla_uf,
        network AS rede,
        CASE WHEN place_no = 5 AND yr = 2024 THEN NULL ELSE CAST(rate AS STRING) END AS taxa_alfabetizacao,
        {_targets("(place_no = 5 AND yr = 2024) OR place_no = 9", "place_no = 7")},
        CASE WHEN place_no = 5 AND yr = 2024 THEN NULL ELSE CAST({_share("present")} AS STRING) END
            AS percentual_participacao,
        {_lineage("meta_alfabetizacao_uf", "last_day")}
    FROM (
        SELECT *, {_share("good")} AS rate
        FROM (
            SELECT
                {_YEAR} AS yr,
                {_PLACE_NO} AS place_no,
                CASE WHEN l_suppkey % 28 % 3 = 0 AND l_linenumber <= 3 THEN ' Municipal ' ELSE 'Pública' END AS network,
                l_returnflag AS delivery,
                count(*) AS n,
                {_ON_TARGET} AS good,
                {_TOOK_PART} AS present,
                max(l_shipdate) AS last_day
            FROM {{lineitem}}
            GROUP BY 1, 2, 3, 4
        ) AS grouped
    ) AS rated"""

_META_MUNICIPIO = f"""
    SELECT
        CAST(yr AS STRING) AS ano,
        CASE WHEN n % 29 = 7 THEN NULL WHEN n % 29 = 8 THEN substr(place, 1, 5) ELSE place END AS id_municipio,
        network AS rede,
        CASE WHEN n % 31 = 3 THEN 'abc' ELSE CAST(rate AS STRING) END AS taxa_alfabetizacao,
        {_targets("n % 11 = 4", "n % 7 = 2")},
        CAST(CAST(floor(rate / 15) AS INT) AS STRING) AS nivel_alfabetizacao,
        CASE WHEN n % 37 = 5 THEN '100.01' ELSE CAST({_share("present")} AS STRING) END AS percentual_participacao,
        {_lineage("meta_alfabetizacao_municipio", "last_day")}
    FROM (
        SELECT *, {_PLACE} AS place, {_share("good")} AS rate
        FROM (
            SELECT
                {_YEAR} AS yr,
                l_suppkey,
                CASE WHEN l_suppkey % 4 = 0 AND l_linenumber <= 3 THEN ' Municipal' ELSE 'Pública ' END AS network,
                l_returnflag AS delivery,
                count(*) AS n,
                {_ON_TARGET} AS good,
                {_TOOK_PART} AS present,
                max(l_shipdate) AS last_day
            FROM {{lineitem}}
            GROUP BY 1, 2, 3, 4
        ) AS grouped
    ) AS rated"""

_META_BRASIL = f"""
    SELECT
        CAST(yr AS STRING) AS ano,
        network AS rede,
        CAST(rate AS STRING) AS taxa_alfabetizacao,
        {_targets("yr = 2029", "network = 'Total '")},
        CAST({_share("present")} AS STRING) AS percentual_participacao,
        {_lineage("meta_alfabetizacao_brasil", "last_day")}
    FROM (
        SELECT *, {_share("good")} AS rate
        FROM (
            SELECT
                {_YEAR} AS yr,
                CASE WHEN l_linenumber = 7 THEN 'Total ' ELSE 'Pública' END AS network,
                l_returnflag AS delivery,
                count(*) AS n,
                {_ON_TARGET} AS good,
                {_TOOK_PART} AS present,
                max(l_shipdate) AS last_day
            FROM {{lineitem}}
            GROUP BY 1, 2, 3
        ) AS grouped
    ) AS rated"""

BRONZE_SQL = {
    "alunos": _ALUNOS,
    "municipio": _MUNICIPIO,
    "uf": _UF,
    "meta_alfabetizacao_uf": _META_UF,
    "meta_alfabetizacao_municipio": _META_MUNICIPIO,
    "meta_alfabetizacao_brasil": _META_BRASIL,
}

# Events as a broker would hand them over: JSON text with every kind of defect, under the broker's columns.
_EVENT_YEAR = "CAST(2023 + event_id % 5 AS STRING)"
_EVENT_STATE = f"substr('{_ACRONYMS}', CAST(user_id % 27 AS INT) * 2 + 1, 2)"

EVENTS_SQL = f"""
    SELECT
        'indicator-events' AS topic,
        CAST(user_id % 2 AS INT) AS partition,
        event_id AS offset,
        ts AS timestamp,
        CASE
            WHEN event_type = 'error' AND value < 5 THEN NULL
            WHEN event_type = 'error' AND value < 10 THEN 'not json ' || CAST(event_id AS STRING)
            WHEN event_type = 'error' AND value < 15 THEN '[1, 2, ' || CAST(event_id AS STRING) || ']'
            ELSE '{{{{"ano": '
                || CASE WHEN event_type = 'purchase' THEN '"' || {_EVENT_YEAR} || '"'
                        WHEN event_type = 'click' AND value < 10 THEN '"' || {_EVENT_YEAR} || '.5"'
                        ELSE {_EVENT_YEAR} END
                || ', "sigla_uf": "' || {_EVENT_STATE} || '", "serie": 2, "rede": '
                || CASE WHEN event_type = 'purchase' THEN '"5"'
                        WHEN event_type = 'view' AND value < 10 THEN '""'
                        ELSE '5' END
                || ', "taxa_alfabetizacao": '
                || CASE WHEN event_type = 'error' AND value < 20 THEN 'null' ELSE CAST(value AS STRING) END
                || CASE WHEN event_type = 'error' AND value >= 20 AND value < 25 THEN ''
                        ELSE ', "media_portugues": ' || CAST(700 + floor(value) / 4e0 AS STRING) END
                || CASE WHEN event_type = 'purchase' THEN ', "proporcao_aluno_nivel_0": 2.7, "proporcao_aluno_nivel_1": '
                             || CAST(floor(value) / 8e0 AS STRING) || ', "proporcao_aluno_nivel_8": "'
                             || CAST(floor(value) / 16e0 AS STRING) || '"'
                        ELSE '' END
                || '}}}}'
        END AS value
    FROM {{events}}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One bronze-shaped table derived from lineitem."""
    return spark.sql(BRONZE_SQL[name], lineitem=table(spark, sf_dir, "lineitem"))


def broker_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The events table, batch or stream, in the shape of broker messages."""
    return spark.sql(EVENTS_SQL, events=events)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a stream of files."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
