"""Folding new bronze files into silver, against builds from all of bronze."""

import random

import pytest
from frames import bronze, lineage

from estrato.plans import silver
from estrato.plans.incremental import fold, fold_silver
from estrato.plans.layers import run_layer
from estrato.sources.layers import read_layer, write_bronze


def _rows(pick, day, count):
    return [
        {
            "ano": pick.choice([2023, 2024, None, "x"]), "id_municipio": str(3500000 + pick.randint(1, 40)), "serie": 2,
            "rede": pick.choice([2, 3]), "taxa_alfabetizacao": pick.randint(0, 100),
            **lineage(ts=f"{day}T0{pick.randint(1, 3)}:00:00-03:00", run=f"run{pick.randint(1, 2)}"),
        }
        for _ in range(count)
    ]


def _content(frame):
    return sorted(map(repr, frame.drop("_slice").collect()))


def _same(spark, cfg, spec=silver.MUNICIPIO):
    whole = silver.build(spec, read_layer(spark, cfg, "bronze", spec.name))
    return _content(read_layer(spark, cfg, "silver", spec.name)) == _content(whole)


def _deliver(spark, cfg, rows, **how):
    spec = silver.MUNICIPIO
    write_bronze(bronze(spark, spec, rows), cfg.path("bronze", spec.name), many_dates=True, **how)


def test_three_deliveries_equal_a_full_build(spark, cfg):
    pick = random.Random(4)
    _deliver(spark, cfg, _rows(pick, "2024-01-01", 120))
    first = fold(spark, cfg, silver.MUNICIPIO, slices=32)
    assert (first.whole, first.folders_read, first.bronze_rows, first.stored_rows) == (True, 1, 120, 0)
    _deliver(spark, cfg, _rows(pick, "2024-01-02", 5), preserve_history=True)
    second = fold(spark, cfg, silver.MUNICIPIO, slices=32)
    assert (second.whole, second.folders_read, second.bronze_rows) == (False, 1, 5)
    assert second.slices_written <= 5 and second.stored_rows < first.rows_written
    assert _same(spark, cfg)
    _deliver(spark, cfg, _rows(pick, "2024-01-02", 3) + _rows(pick, "2023-12-31", 4), mode="append")
    third = fold(spark, cfg, silver.MUNICIPIO, slices=32)
    assert (third.whole, third.folders_read, third.bronze_rows) == (False, 2, 7)
    assert _same(spark, cfg)


def test_untouched_slices_keep_their_files_and_nothing_new_reads_nothing(spark, cfg, tmp_path):
    pick = random.Random(5)
    _deliver(spark, cfg, _rows(pick, "2024-01-01", 150))
    fold(spark, cfg, silver.MUNICIPIO, slices=16)
    files = lambda: {p for p in (tmp_path / "lake/prod/silver/municipio").rglob("part-*")}
    before = files()
    again = fold(spark, cfg, silver.MUNICIPIO, slices=16)
    assert (again.bronze_rows, again.stored_rows, again.rows_written) == (0, 0, 0) and files() == before
    _deliver(spark, cfg, _rows(pick, "2024-01-02", 1), preserve_history=True)
    assert fold(spark, cfg, silver.MUNICIPIO, slices=16).slices_written == 1
    assert len(before - files()) >= 1 and {p.parent for p in before ^ files()} == {p.parent for p in before - files()}
    assert _same(spark, cfg)


@pytest.mark.parametrize("how", [{"preserve_history": True}, {}])
def test_a_date_that_is_delivered_anew_takes_its_rows_back(spark, cfg, how):
    pick = random.Random(6)
    _deliver(spark, cfg, _rows(pick, "2024-01-01", 50))
    _deliver(spark, cfg, _rows(pick, "2024-01-02", 50), preserve_history=True)
    fold(spark, cfg, silver.MUNICIPIO, slices=4)
    _deliver(spark, cfg, _rows(pick, "2024-01-02", 2), **how)
    assert fold(spark, cfg, silver.MUNICIPIO, slices=4).whole
    assert _same(spark, cfg)


def test_streams_are_folded_in_and_gold_is_built_on_slices(spark, cfg):
    state = {"ano": 2024, "sigla_uf": "sp", "serie": 2, "rede": 5, "taxa_alfabetizacao": 50}
    place = {"ano": 2024, "id_municipio": "3550308", "serie": 2, "rede": 3, "taxa_alfabetizacao": 50}
    rows = {
        "uf": state, "municipio": place, "alunos": {**place, "id_escola": "1", "id_aluno": "a"},
        "meta_alfabetizacao_uf": {**state, "rede": "P"}, "meta_alfabetizacao_municipio": {**place, "rede": "P"},
        "meta_alfabetizacao_brasil": {"ano": 2024, "rede": "P"},
    }
    for spec in silver.SILVER:
        write_bronze(bronze(spark, spec, [rows[spec.name]]), cfg.path("bronze", spec.name))
    assert [r.rows_written for r in fold_silver(spark, cfg, slices=2)] == [1] * 6
    newer = {**state, "taxa_alfabetizacao": 61, **lineage(ts="2025-01-01T00:00:00-03:00")}
    write_bronze(bronze(spark, silver.UF, [newer]), cfg.path("bronze", "uf_stream"))
    (result,) = fold_silver(spark, cfg, tables=["uf"], slices=2)
    assert (result.whole, result.bronze_rows) == (False, 1)
    assert read_layer(spark, cfg, "silver", "uf").first().taxa_alfabetizacao_pct == 61.0
    assert [r.rows for r in run_layer(spark, cfg, "gold")] == [1, 1, 1]


def test_no_bronze_is_an_error(spark, cfg):
    with pytest.raises(ValueError, match="no bronze files"):
        fold(spark, cfg, silver.UF)
