import threading
import time
from functools import partial

import __spark_entry__ as registry
import pytest
from frames import bronze, lineage

from estrato.operators.latest import latest_by_key
from estrato.plans import silver
from estrato.plans.layers import STEPS, engine_stats, job_group, run_layer
from estrato.session import run_at_once
from estrato.sources.layers import read_layer, write_bronze

PLACE = {"ano": 2024, "id_municipio": "3550308", "serie": 2, "rede": 3, "taxa_alfabetizacao": 50}
STATE = {"ano": 2024, "sigla_uf": "sp", "serie": 2, "rede": 5, "taxa_alfabetizacao": 50}
ROWS = {
    "uf": [STATE, {**STATE, "ano": 2023}],
    "municipio": [PLACE],
    "alunos": [{**PLACE, "id_escola": "1", "id_aluno": "a", "presenca": 1, "alfabetizado": 1}],
    "meta_alfabetizacao_uf": [{**STATE, "rede": "Pública", "meta_alfabetizacao_2030": 80}],
    "meta_alfabetizacao_municipio": [{**PLACE, "rede": "Pública", "meta_alfabetizacao_2030": 80}],
    "meta_alfabetizacao_brasil": [{"ano": 2024, "rede": "Pública", "taxa_alfabetizacao": 59}],
}


@pytest.fixture
def loaded(spark, cfg):
    for spec in silver.SILVER:
        write_bronze(bronze(spark, spec, ROWS[spec.name]), cfg.path("bronze", spec.name))
    return cfg


def test_all_layers_run_in_order_and_report_their_rows(spark, loaded):
    done = {layer: run_layer(spark, loaded, layer) for layer in ("silver", "gold", "quality")}
    assert [r.table for r in done["silver"]] == [s.name for s in silver.SILVER]
    assert {r.table: r.rows for r in done["silver"]} == {
        "uf": 2, "municipio": 1, "alunos": 1, "meta_alfabetizacao_uf": 1, "meta_alfabetizacao_municipio": 1,
        "meta_alfabetizacao_brasil": 1,
    }
    assert [(r.table, r.rows) for r in done["gold"]] == [
        ("indicador_municipio", 1), ("metas_vs_resultados_municipio", 1), ("evolucao_alfabetizacao_uf", 2),
    ]
    assert [(r.table, r.rows) for r in done["quality"]] == [("validation_results", 36)]
    again = run_layer(spark, loaded, "gold")
    assert [r.rows for r in again] == [r.rows for r in done["gold"]]


def test_a_dry_run_shows_plans_and_writes_nothing(spark, loaded, tmp_path):
    run_layer(spark, loaded, "silver")
    before = sorted(p.relative_to(tmp_path) for p in tmp_path.rglob("*"))
    tracker = spark.sparkContext.statusTracker()
    jobs = len(tracker.getJobIdsForGroup(None))
    for layer in ("silver", "quality"):
        run_layer(spark, loaded, layer, dry_run=True)
    assert len(tracker.getJobIdsForGroup(None)) == jobs
    for layer in ("silver", "gold", "quality"):
        results = run_layer(spark, loaded, layer, dry_run=True)
        assert [r.table for r in results] == [s.table for s in STEPS[layer]]
        assert all(r.path is None and "Physical Plan" in r.plan for r in results)
    assert sorted(p.relative_to(tmp_path) for p in tmp_path.rglob("*")) == before


@pytest.mark.parametrize(("table", "more"), [("uf_stream", None), ("uf_again", {"uf": ["uf_again"]})])
def test_a_stream_or_a_further_table_can_feed_a_silver_table(spark, loaded, table, more):
    newer = {**STATE, "taxa_alfabetizacao": 61, **lineage(ts="2025-01-01T00:00:00-03:00")}
    write_bronze(bronze(spark, silver.UF, [newer]), loaded.path("bronze", table))
    run_layer(spark, loaded, "silver", more_bronze=more)
    rates = {r.ano: r.taxa_alfabetizacao_pct for r in read_layer(spark, loaded, "silver", "uf").collect()}
    assert rates == {2023: 50.0, 2024: 61.0}


def test_a_missing_input_stops_the_layer(spark, cfg):
    with pytest.raises(Exception, match="(?i)path"):
        run_layer(spark, cfg, "silver")


def test_unknown_layers_are_errors(spark, cfg):
    with pytest.raises(ValueError, match="no steps"):
        run_layer(spark, cfg, "bronze")


def test_registered_layers_are_catalog_tables(spark, loaded):
    run_layer(spark, loaded, "silver", register=True)
    try:
        assert spark.table("silver.uf").count() == 2
        run_layer(spark, loaded, "silver", register=True)
        assert spark.table("silver.uf").count() == 2
    finally:
        spark.sql("DROP DATABASE silver CASCADE")


def test_steps_tell_what_they_read(spark, loaded, tmp_path):
    spark.sparkContext.setJobGroup("mine", "the caller's group")
    results = run_layer(spark, loaded, "silver")
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == "mine"
    for result in results:
        files = (tmp_path / "lake/prod/bronze" / result.table).rglob("part-*.parquet")
        assert result.bytes_read == sum(f.stat().st_size for f in files) > 0
        assert result.engine.rows_scanned == len(ROWS[result.table])
        assert result.engine.bytes_scanned > 0 and result.engine.bytes_written > 0 and result.engine.engine_ms > 0
    gold = {r.table: r for r in run_layer(spark, loaded, "gold")}
    used = ("uf", "meta_alfabetizacao_uf", "meta_alfabetizacao_brasil")
    sizes = [f.stat().st_size for t in used for f in (tmp_path / "lake/prod/silver" / t).rglob("part-*.parquet")]
    assert gold["evolucao_alfabetizacao_uf"].bytes_read == sum(sizes)


def test_the_quality_layer_takes_what_the_silver_writes_measured(spark, loaded):
    done = run_layer(spark, loaded, "silver")
    (scanned,) = run_layer(spark, loaded, "quality")
    plain = read_layer(spark, loaded, "quality", "validation_results").drop("execution_timestamp_utc").collect()
    (measured,) = run_layer(spark, loaded, "quality", measured=done)
    found = read_layer(spark, loaded, "quality", "validation_results").drop("execution_timestamp_utc").collect()
    assert len(found) == 36 and sorted(map(str, found)) == sorted(map(str, plain))
    # One scan of each table less; the numbers of a table are one row of a range, which counts as read.
    saved = sum(r.rows for r in done) - len(done)
    assert scanned.engine.rows_scanned - measured.engine.rows_scanned == saved


def test_tables_of_a_layer_are_built_at_once_with_the_same_results(spark, loaded):
    together = threading.Barrier(2, timeout=60)
    assert run_at_once(spark, [together.wait] * 2, 2) in ([0, 1], [1, 0])
    plain = run_layer(spark, loaded, "silver")
    rows = {r.table: sorted(map(str, read_layer(spark, loaded, "silver", r.table).collect())) for r in plain}
    at_once = run_layer(spark, loaded, "silver", at_once=3)
    told = [[(r.table, r.rows, r.bytes_read, r.engine.rows_scanned, r.measured) for r in run] for run in (plain, at_once)]
    assert told[0] == told[1]
    for result in at_once:
        assert sorted(map(str, read_layer(spark, loaded, "silver", result.table).collect())) == rows[result.table]


def test_after_a_failure_no_further_work_begins(spark):
    begun = []

    def work(n):
        begun.append(n)
        if n == 0:
            raise RuntimeError("first")
        time.sleep(0.5)

    with pytest.raises(RuntimeError, match="first"):
        run_at_once(spark, [partial(work, n) for n in range(8)], 2)
    assert len(begun) < 8


def test_deliveries_of_a_date_a_year_are_stored_without_a_shuffle(spark, cfg):
    rows = bronze(spark, silver.ALUNOS, [{"_ingestion_date": f"{2020 + n % 3}-12-31", "id_aluno": n} for n in range(30)])
    with job_group(spark, "deliveries"):
        registry._write_deliveries(spark, cfg, {"alunos": rows})
    done = engine_stats(spark, "deliveries")
    assert done.bytes_shuffled == 0 < done.bytes_written
    assert read_layer(spark, cfg, "bronze", "alunos").groupBy("_ingestion_date").count().count() == 3


def test_students_are_read_once_whether_or_not_their_key_is_whole(spark, cfg):
    some = [{"ano": 2024, "id_municipio": "3550308", "id_escola": "1", "id_aluno": n % 5 or None} for n in range(40)]
    rows = bronze(spark, silver.ALUNOS, [{**row, "proficiencia": n} for n, row in enumerate(some)])
    write_bronze(rows.repartition(4), cfg.path("bronze", "alunos"))
    stored = read_layer(spark, cfg, "bronze", "alunos")
    with job_group(spark, "students"):
        found = silver.build(silver.ALUNOS, stored).collect()
    assert engine_stats(spark, "students").rows_scanned == 40
    plain = latest_by_key(silver.typed(silver.ALUNOS, stored), silver.ALUNOS.key, silver.newest_first()).collect()
    told = [sorted((r.id_aluno or "", r.proficiencia) for r in rows) for rows in (found, plain)]
    assert told[0] == told[1] and len(found) == 5
