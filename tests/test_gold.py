import random

import pytest
from frames import bronze
from pyspark.sql import Window
from pyspark.sql import functions as F

from estrato.plans import gold, reports, silver

# Published state results of 2023 and 2024, network 5.
STATES = [
    (2023, "RS", 63.43), (2023, "CE", 84.46), (2023, "PI", 52.48), (2023, "ES", 67.93), (2023, "GO", 66.74),
    (2023, "MS", 47.45), (2023, "MG", 59.81),
    (2024, "CE", 85.31), (2024, "ES", 71.69), (2024, "MG", 72.07), (2024, "GO", 72.74), (2024, "PI", 59.82),
    (2024, "MS", 55.87), (2024, "RS", 44.67), (2024, "AC", 51.38),
]


def _uf(spark, rows=STATES, network=5):
    return silver.build(
        silver.UF,
        bronze(
            spark,
            silver.UF,
            [{"ano": a, "sigla_uf": s, "serie": 2, "rede": network, "taxa_alfabetizacao": x} for a, s, x in rows],
        ),
    )


def _meta(spark, spec, rows):
    return silver.build(spec, bronze(spark, spec, rows))


def _evolution(spark, uf, state_rows=(), national_rows=()):
    return gold.evolucao_alfabetizacao_uf(
        uf, _meta(spark, silver.META_UF, state_rows), _meta(spark, silver.META_BRASIL, national_rows)
    )


def test_evolution_of_the_seed_states(spark):
    rows = {(r.ano, r.sigla_uf): r for r in _evolution(spark, _uf(spark)).collect()}
    assert len(rows) == 15
    leaders = sorted((r.ranking_uf_no_ano, u) for (a, u), r in rows.items() if a == 2024)[:4]
    assert leaders == [(1, "CE"), (2, "GO"), (3, "MG"), (4, "ES")]
    change = {u: r.variacao_alfabetizacao_uf_pp for (a, u), r in rows.items() if a == 2024}
    assert (change["MG"], change["MS"], change["PI"], change["RS"]) == (12.26, 8.42, 7.34, -18.76)
    assert change["AC"] is None and rows[(2024, "AC")].resultado_alfabetizacao_uf_ano_anterior_pct is None
    assert rows[(2024, "CE")].regiao == "Nordeste"
    assert rows[(2024, "CE")].chave_gold_evolucao_alfabetizacao_uf == "2024_CE_5"
    assert {r.status_meta_ano for r in rows.values()} == {"SEM_META_ANUAL"}
    assert {r.status_meta_2030 for r in rows.values()} == {"ABAIXO_META_2030"}


def test_equal_rates_share_a_rank(spark):
    rows = [(2024, "SP", 70.0), (2024, "RJ", 70.0), (2024, "MG", 60.0)]
    got = {r.sigla_uf: r.ranking_uf_no_ano for r in _evolution(spark, _uf(spark, rows)).collect()}
    assert got == {"SP": 1, "RJ": 1, "MG": 3}


def test_state_and_national_targets_fan_out_and_count_in_the_rank(spark):
    targets = [
        {"ano": 2024, "sigla_uf": "CE", "rede": r, "meta_alfabetizacao_2024": 80, "meta_alfabetizacao_2030": 90}
        for r in ("Pública", "Municipal")
    ]
    national = [{"ano": 2024, "rede": "Pública", "taxa_alfabetizacao": 59.2, "percentual_participacao": 85}]
    rows = [r for r in _evolution(spark, _uf(spark), targets, national).collect() if r.ano == 2024]
    ce = sorted((r for r in rows if r.sigla_uf == "CE"), key=lambda r: r.rede_meta)
    assert [r.rede_meta for r in ce] == ["Municipal", "Pública"]
    assert {r.ranking_uf_no_ano for r in ce} == {1}
    assert [r.ranking_uf_no_ano for r in rows if r.sigla_uf == "GO"] == [3]
    assert {(r.status_meta_ano, r.status_meta_2030) for r in ce} == {("ATINGIU_META_ANUAL", "ABAIXO_META_2030")}
    assert {(r.diferenca_meta_ano_pp, r.diferenca_meta_2030_pp, r.diferenca_brasil_pp) for r in ce} == {
        (5.31, -4.69, 26.11)
    }
    # The first copy looks back to 2023; the second, ordered after it, sees the same year.
    assert [r.variacao_alfabetizacao_uf_pp for r in ce] == [0.85, 0.0]


def test_only_valid_states_of_the_whole_state_network_count(spark):
    uf = _uf(spark, [(2024, "SP", 50.0)], network=3).unionByName(_uf(spark, [(2024, "SPX", 50.0), (2024, "RJ", 101)]))
    assert _evolution(spark, uf).count() == 0


def _municipio(spark, rows):
    return silver.build(silver.MUNICIPIO, bronze(spark, silver.MUNICIPIO, rows))


def _place(year=2024, place="3550308", network=3, rate=50.0):
    return {"ano": year, "id_municipio": place, "serie": 2, "rede": network, "taxa_alfabetizacao": rate}


@pytest.mark.parametrize(
    ("year", "target_2024", "status"),
    [
        (2023, 40, "SEM_META_ANUAL"),
        (2024, 50, "ATINGIU_META_ANUAL"),
        (2024, 50.01, "ABAIXO_META_ANUAL"),
        (2024, None, "META_NAO_DISPONIVEL"),
        (2031, 40, "META_NAO_DISPONIVEL"),
    ],
)
def test_municipal_annual_status(spark, year, target_2024, status):
    targets = [{"ano": year, "id_municipio": "3550308", "rede": "Pública", "meta_alfabetizacao_2024": target_2024}]
    metas = _meta(spark, silver.META_MUNICIPIO, targets)
    row = gold.metas_vs_resultados_municipio(_municipio(spark, [_place(year)]), metas).first()
    assert row.status_meta_ano == status
    assert row.status_meta_2030 == "ABAIXO_META_2030"


def test_targets_ignore_the_network_and_fan_out(spark):
    metas = _meta(
        spark,
        silver.META_MUNICIPIO,
        [{"ano": 2024, "id_municipio": "3550308", "rede": r, "meta_alfabetizacao_2030": 80} for r in ("A", "B")],
    )
    places = [_place(rate=80.0), _place(network=2), _place(place="1100015", rate=49.99), _place(place="355030")]
    rows = gold.metas_vs_resultados_municipio(_municipio(spark, places), metas).collect()
    assert sorted((r.id_municipio, r.rede_meta, r.status_meta_2030) for r in rows if r.rede_meta) == [
        ("3550308", "A", "ATINGIU_META_2030"),
        ("3550308", "B", "ATINGIU_META_2030"),
    ]
    (alone,) = [r for r in rows if r.rede_meta is None]
    assert (alone.sigla_uf, alone.faixa_prioridade_intervencao) == ("RO", "ALTA_PRIORIDADE")
    below = reports.municipalities_below_target(gold.metas_vs_resultados_municipio(_municipio(spark, places), metas))
    assert below.count() == 0


def test_indicators_with_and_without_a_sample(spark):
    students = [
        {
            "ano": 2024, "id_municipio": "3550308", "id_escola": "1", "id_aluno": str(n), "serie": 2, "rede": 3,
            "presenca": 1, "alfabetizado": int(n < 2), "proficiencia": 700 + n, "peso_aluno": 0.5,
        }
        for n in range(3)
    ]
    alunos = silver.build(silver.ALUNOS, bronze(spark, silver.ALUNOS, students))
    places = _municipio(spark, [_place(rate=80.0), _place(place="9900001", rate=79.99)])
    rows = {r.id_municipio: r for r in gold.indicador_municipio(places, alunos).collect()}
    sp, unknown = rows["3550308"], rows["9900001"]
    assert (sp.qtd_alunos_amostra, sp.taxa_alfabetizacao_alunos_amostra_pct) == (3, 66.67)
    assert (sp.taxa_presenca_alunos_amostra_pct, sp.media_proficiencia_alunos_amostra) == (100.0, 701.0)
    assert (sp.status_meta_2030, sp.diferenca_meta_2030_pp) == ("ACIMA_OU_IGUAL_META_2030", 0.0)
    assert (unknown.codigo_uf, unknown.sigla_uf, unknown.regiao) == ("99", None, None)
    assert unknown.qtd_alunos_amostra is None and unknown.taxa_presenca_alunos_amostra_pct is None
    assert (unknown.status_meta_2030, unknown.diferenca_meta_2030_pp) == ("ABAIXO_META_2030", -0.01)


def test_reports(spark):
    evolution = _evolution(spark, _uf(spark))
    best = reports.best_evolving_states(evolution, top=3).collect()
    assert [(r.sigla_uf, r.variacao_alfabetizacao_uf_pp) for r in best] == [("MG", 12.26), ("MS", 8.42), ("PI", 7.34)]
    spread = {(r.ano, r.regiao): r for r in reports.regional_inequality(evolution).collect()}
    south_east = spread[(2024, "Sudeste")]
    assert (south_east.qtd_resultados, south_east.media_pct, south_east.amplitude_pp) == (2, 71.88, 0.38)


def test_evolution_equals_windows_over_the_joined_copies(spark):
    """Random years, grades and networks, with missing years and networks, against the definition by windows."""
    rng = random.Random(11)
    years, states, networks = [2023, 2024, 2025, "x"], ["CE", "SP", "RJ", "MG", "BA", "AC", "ZZ"], ["A", "B", None]
    rates = [10, 20, 20.5, 99.99, None]
    results = [
        {"ano": a, "sigla_uf": u, "serie": g, "rede": 5, "taxa_alfabetizacao": rng.choice(rates)}
        for a in years for u in states for g in (2, 5, 9, None) if rng.random() < 0.9
    ]
    targets = [
        {"ano": a, "sigla_uf": u, "rede": n, "meta_alfabetizacao_2024": rng.choice([15, 60, None])}
        for a in years for u in states for n in networks if rng.random() < 0.6
    ]
    national = [
        {"ano": a, "rede": n, "taxa_alfabetizacao": rng.choice([15, 60, None])}
        for a in years for n in networks if rng.random() < 0.7
    ]
    uf = silver.build(silver.UF, bronze(spark, silver.UF, results))
    metas, brasil = _meta(spark, silver.META_UF, targets), _meta(spark, silver.META_BRASIL, national)

    x = F.col("resultado_alfabetizacao_uf_pct")
    copies = (
        uf.filter("rede = 5 AND flag_sigla_uf_valida AND flag_taxa_alfabetizacao_valida")
        .select("ano", "sigla_uf", "serie", F.col("taxa_alfabetizacao_pct").alias("resultado_alfabetizacao_uf_pct"))
        .join(metas.select("ano", "sigla_uf", F.col("rede").alias("rede_meta")), ["ano", "sigla_uf"], "left")
        .join(
            brasil.select(
                "ano", F.col("rede").alias("b"), F.col("taxa_alfabetizacao_pct").alias("taxa_alfabetizacao_brasil_pct")
            ),
            ["ano"],
            "left",
        )
    )
    order = [F.col("ano").asc_nulls_last()] + [F.col(c).asc_nulls_first() for c in ("serie", "rede_meta", "b")]
    previous = F.lag(x).over(Window.partitionBy("sigla_uf").orderBy(*order))
    names = [
        "ano", "sigla_uf", "serie", "rede_meta", "taxa_alfabetizacao_brasil_pct",
        "resultado_alfabetizacao_uf_ano_anterior_pct", "variacao_alfabetizacao_uf_pp", "ranking_uf_no_ano",
    ]
    expected = copies.withColumns(
        {
            names[5]: previous,
            names[6]: F.round(x - previous, 2),
            names[7]: F.rank().over(Window.partitionBy("ano").orderBy(x.desc_nulls_last())).cast("bigint"),
        }
    )
    got = gold.evolucao_alfabetizacao_uf(uf, metas, brasil)
    assert expected.count() > 100
    assert sorted(got.select(names).collect(), key=repr) == sorted(expected.select(names).collect(), key=repr)
