import random

import pytest
from frames import bronze, lineage, plan_of
from pyspark.sql import functions as F

from estrato.functions.casts import INT, Cast
from estrato.operators.latest import latest_by_key
from estrato.operators.standardize import standardize
from estrato.plans import silver


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_bad_values_become_null_and_keys_are_normalised(spark):
    rows = [
        {"ano": "2024", "sigla_uf": "\t sp \n", "serie": "2", "rede": "x", "taxa_alfabetizacao": "abc"},
    ]
    row = _one(silver.build(silver.UF, bronze(spark, silver.UF, rows)))
    assert (row.ano, row.sigla_uf, row.serie, row.rede, row.taxa_alfabetizacao_pct) == (2024, "SP", 2, None, None)
    assert row.flag_sigla_uf_valida and not row.flag_taxa_alfabetizacao_valida
    assert row.chave_uf_ano_serie_rede is None


def test_numeric_fractions_round_half_up_and_text_fractions_are_not_integers(spark):
    numbers = spark.createDataFrame([(2.5,), (2.4,), (-2.5,), (float("nan"),), (1e12,)], "x double")
    assert [r.x for r in standardize(numbers, [Cast("x", INT)]).collect()] == [3, 2, -3, None, None]
    texts = spark.createDataFrame([("2.0",), ("",), ("7",), (None,)], "x string")
    assert [r.x for r in standardize(texts, [Cast("x", INT)]).collect()] == [None, None, 7, None]


def test_target_networks_are_trimmed_and_stay_text(spark):
    row = _one(silver.build(silver.META_BRASIL, bronze(spark, silver.META_BRASIL, [{"ano": 2024, "rede": " Pública "}])))
    assert row.rede == "Pública"
    assert row.chave_meta_brasil_ano_rede == "2024_Pública"


@pytest.mark.parametrize(
    ("rate", "valid"),
    [("-1", False), ("0", True), ("100", True), ("100.01", False), (None, False), ("NaN", False), ("abc", False)],
)
def test_rate_flag(spark, rate, valid):
    row = _one(silver.build(silver.UF, bronze(spark, silver.UF, [{"ano": 2024, "taxa_alfabetizacao": rate}])))
    assert row.flag_taxa_alfabetizacao_valida is valid


@pytest.mark.parametrize(
    ("value", "valid"), [("0", True), ("1", True), ("2", False), (None, False)],
)
def test_binary_flags(spark, value, valid):
    row = _one(silver.build(silver.ALUNOS, bronze(spark, silver.ALUNOS, [{"alfabetizado": value, "presenca": value}])))
    assert row.flag_alfabetizado_valido is valid
    assert row.flag_presenca_valida is valid


@pytest.mark.parametrize(("value", "valid"), [("-1", False), ("0", True), (None, True), ("NaN", False)])
def test_missing_measurements_pass_and_negative_or_nan_ones_do_not(spark, value, valid):
    rows = [{"proficiencia": value, "peso_aluno": value}]
    row = _one(silver.build(silver.ALUNOS, bronze(spark, silver.ALUNOS, rows)))
    assert row.flag_proficiencia_valida is valid
    assert row.flag_peso_aluno_valido is valid


@pytest.mark.parametrize(
    ("place", "valid"), [("3550308", True), ("355030", False), ("35503080", False), (None, False)],
)
def test_municipality_flag(spark, place, valid):
    row = _one(silver.build(silver.MUNICIPIO, bronze(spark, silver.MUNICIPIO, [{"id_municipio": place}])))
    assert row.flag_id_municipio_valido is valid


def test_level_distribution_flag(spark):
    none = _one(silver.build(silver.UF, bronze(spark, silver.UF, [{}])))
    last = _one(silver.build(silver.UF, bronze(spark, silver.UF, [{"proporcao_aluno_nivel_8": "0"}])))
    assert (none.flag_possui_distribuicao_niveis, last.flag_possui_distribuicao_niveis) == (False, True)


def test_target_flags(spark):
    targets = {f"meta_alfabetizacao_{y}": "50" for y in range(2024, 2031)}
    good = _one(silver.build(silver.META_UF, bronze(spark, silver.META_UF, [{**targets}])))
    assert good.flag_meta_2024_valida and good.flag_metas_2025_2030_validas and good.flag_registro_com_indicadores
    gap = _one(
        silver.build(silver.META_UF, bronze(spark, silver.META_UF, [{**targets, "meta_alfabetizacao_2027": None}]))
    )
    assert gap.flag_meta_2024_valida and not gap.flag_metas_2025_2030_validas
    empty = _one(silver.build(silver.META_UF, bronze(spark, silver.META_UF, [{"ano": 2024}])))
    assert not empty.flag_registro_com_indicadores
    level = _one(silver.build(silver.META_MUNICIPIO, bronze(spark, silver.META_MUNICIPIO, [{"nivel_alfabetizacao": 6}])))
    assert not level.flag_nivel_alfabetizacao_valido


def test_the_newest_row_wins_by_text_order(spark):
    key = {"ano": 2024, "sigla_uf": "SP", "serie": 2, "rede": 5}
    rows = [
        {**key, "taxa_alfabetizacao": 1, **lineage(ts="2024-01-01T08:00:00-03:00", run="a")},
        {**key, "taxa_alfabetizacao": 2, **lineage(ts="2024-01-02T08:00:00-03:00", run="a")},
        {**key, "taxa_alfabetizacao": 3, **lineage(ts="2024-01-02T08:00:00-03:00", run="b")},
        {**key, "taxa_alfabetizacao": 4, **lineage(ts="2023-12-31T08:00:00-03:00", run="z")},
        {**key, "taxa_alfabetizacao": 5, "_ingestion_timestamp_utc": None},
    ]
    assert _one(silver.build(silver.UF, bronze(spark, silver.UF, rows))).taxa_alfabetizacao_pct == 3.0


def test_rows_with_a_null_key_part_form_one_group_and_have_no_composite_key(spark):
    rows = [{"ano": 2024, "id_municipio": "3550308", "id_escola": "1", "caderno": n} for n in range(5)]
    rows.append({"ano": 2024, "id_municipio": "3550308", "id_escola": "1", "id_aluno": "a"})
    kept = silver.build(silver.ALUNOS, bronze(spark, silver.ALUNOS, rows)).collect()
    assert len(kept) == 2
    assert {r.chave_aluno_ano_municipio_escola for r in kept} == {None, "2024_3550308_1_a"}


def test_ties_do_not_depend_on_row_order_or_partitioning(spark):
    key = {"ano": 2024, "sigla_uf": "SP", "serie": 2, "rede": 5}
    rows = [{**key, "taxa_alfabetizacao": n, "media_portugues": n % 3} for n in range(40)]
    seen = set()
    for partitions in (1, 3, 8):
        random.Random(partitions).shuffle(rows)
        df = bronze(spark, silver.UF, rows).repartition(partitions)
        seen.add(_one(silver.build(silver.UF, df)).taxa_alfabetizacao_pct)
    assert seen == {0.0}


def test_a_hot_key_is_trimmed_before_the_shuffle(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("ts"),
    )
    latest = latest_by_key(rows.repartition(8), ["k"], ["ts"])
    assert "WindowGroupLimit" in plan_of(latest) and "Partial" in plan_of(latest)
    assert latest.count() == 20001
    assert latest.filter("k IS NULL").first().ts == max(str(n) for n in range(0, 30000, 3))


def test_batch_and_stream_tables_of_different_types_are_united(spark):
    row = {"ano": 2024, "sigla_uf": "SP", "serie": 2, "rede": 5, "taxa_alfabetizacao": "50"}
    batch = bronze(spark, silver.UF, [row])
    newer = bronze(spark, silver.UF, [{**row, "taxa_alfabetizacao": "60", **lineage(ts="2025-01-01T00:00:00-03:00")}])
    stream = newer.withColumn("ano", F.col("ano").cast("int")).withColumn(
        "taxa_alfabetizacao", F.col("taxa_alfabetizacao").cast("double")
    )
    assert _one(silver.build(silver.UF, batch, stream)).taxa_alfabetizacao_pct == 60.0


@pytest.mark.parametrize("spec", silver.SILVER, ids=lambda s: s.name)
def test_every_table_ends_with_its_key_and_the_lineage(spark, spec):
    columns = silver.build(spec, bronze(spark, spec, [])).columns
    assert columns[-7:] == list(silver.LINEAGE)
    assert columns[-8] == spec.key_name
    assert [c for c in columns if c.startswith("flag_")] == list(spec.flags)


def test_keys_that_name_rows_are_sorted_once_and_missing_ones_are_still_trimmed(spark):
    rows = [(n % 5, None if n % 3 == 0 else f"s{n // 4}", f"t{n % 7}", n % 2) for n in range(400)] * 2
    df = spark.createDataFrame(rows, "a int, b string, ts string, v int").repartition(6)
    once = latest_by_key(df, ["a", "b"], ["ts"], names_rows=True)
    plain = latest_by_key(df, ["a", "b"], ["ts"])
    below = [part.split("Exchange", 1)[1] for part in plan_of(once).split("Window [")[1:]]
    assert ["Partial" in part for part in below] == [False, True]
    assert sorted(map(repr, once.collect())) == sorted(map(repr, plain.collect()))
    assert silver.ALUNOS.names_rows and not any(s.names_rows for s in silver.SILVER if s is not silver.ALUNOS)
