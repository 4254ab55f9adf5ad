"""Official two-digit state codes, state acronyms and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values: (state code, acronym, region).
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


def states(spark: SparkSession) -> DataFrame:
    """The 27 states as a table: codigo_uf, sigla_uf, regiao."""
    rows = ", ".join(f"('{code}', '{acronym}', '{region}')" for code, acronym, region in STATES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS states(codigo_uf, sigla_uf, regiao)")
