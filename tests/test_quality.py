from datetime import datetime, timedelta, timezone

from frames import bronze, plan_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from estrato.operators.checks import duplicate_groups, orphan_rows, row_measures, run_checks
from estrato.plans import quality, silver


def _tables(spark, rows=None):
    rows = rows or {}
    return {s.name: silver.build(s, bronze(spark, s, rows.get(s.name, []))) for s in silver.SILVER}


def _by_name(df):
    return {(r.table_name, r.check_name): r for r in df.collect()}


def test_there_are_36_checks_with_distinct_names():
    assert len(quality.CHECKS) == 36
    assert len({(c.table, c.name) for c in quality.CHECKS}) == 36


def test_over_empty_tables_row_checks_fail_without_a_count_and_the_others_pass(spark):
    results = quality.validation_results(_tables(spark), executed_at=F.lit("now"))
    rows = _by_name(results)
    assert len(rows) == 36
    for row in rows.values():
        assert row.total_records == 0 and row.failed_pct == 0.0 and row.execution_timestamp_utc == "now"
        if row.check_type in ("DUPLICIDADE", "CHAVE_RELACIONAMENTO"):
            assert (row.failed_records, row.status) == (0, "PASS")
        else:
            assert (row.failed_records, row.status) == (None, "FAIL")


def test_failures_are_counted(spark):
    place = {"ano": 2024, "serie": 2, "rede": 3}
    rows = {
        "uf": [
            {"ano": 2024, "sigla_uf": "SP", "taxa_alfabetizacao": 50},
            {"ano": 2024, "sigla_uf": "SPX", "taxa_alfabetizacao": 101},
            {"ano": 2024, "taxa_alfabetizacao": "NaN"},
        ],
        "municipio": [{**place, "id_municipio": "3550308", "taxa_alfabetizacao": 50}],
        "alunos": [
            {"ano": 2024, "id_municipio": "3550308", "id_aluno": "a", "alfabetizado": 1, "proficiencia": -1},
            {"ano": 2024, "id_municipio": "1100015", "id_aluno": "b", "alfabetizado": 2, "proficiencia": "NaN"},
            {"ano": 2024, "alfabetizado": None},
        ],
        "meta_alfabetizacao_uf": [
            {"ano": 2024, "sigla_uf": "SP", "rede": "A", "meta_alfabetizacao_2030": 80},
            {"ano": 2024, "sigla_uf": "RJ", "rede": "A", "meta_alfabetizacao_2030": 81},
            {"ano": 2024, "sigla_uf": "AC", "rede": "A"},
        ],
    }
    results = _by_name(quality.validation_results(_tables(spark, rows)))

    def failed(table, check):
        return results[(table, check)].failed_records

    assert failed("uf", "invalid_sigla_uf") == 2
    assert failed("uf", "invalid_quality_flag_sigla_uf") == 2
    assert failed("uf", "invalid_taxa_alfabetizacao") == 2
    assert results[("uf", "invalid_sigla_uf")].failed_pct == 66.6667
    assert results[("uf", "invalid_sigla_uf")].status == "FAIL"
    assert failed("alunos", "missing_id_aluno") == 1
    assert failed("alunos", "invalid_id_municipio") == 1
    assert failed("alunos", "invalid_alfabetizado") == 2
    assert failed("alunos", "invalid_presenca") == 3
    assert failed("alunos", "invalid_proficiencia") == 1
    assert failed("alunos", "invalid_peso_aluno") == 0
    assert failed("alunos", "aluno_sem_resultado_municipio") == 2
    assert failed("meta_alfabetizacao_uf", "uf_meta_sem_resultado_uf") == 2
    assert failed("meta_alfabetizacao_uf", "invalid_meta_2030") == 2
    assert failed("meta_alfabetizacao_uf", "registro_sem_indicadores") == 1
    assert results[("municipio", "duplicate_key_ano_id_municipio_serie_rede")].status == "PASS"
    assert results[("municipio", "duplicate_key_ano_id_municipio_serie_rede")].total_records == 1


def test_duplicates_count_groups_and_null_keys_group_together(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, "b")], "x int, y string")
    assert tuple(duplicate_groups(df, ["x", "y"]).first()) == (6, 2)


def test_orphans_count_rows_null_keys_and_survive_a_hot_key(spark):
    child = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "cold").alias("k")
    )
    parent = spark.createDataFrame([("cold",), ("cold",), (None,)], "k string")
    result = orphan_rows(child, parent, "k")
    assert tuple(result.first()) == (9000, 6000)
    # The child is aggregated before it is joined.
    plan = plan_of(result)
    assert plan.index("Join") < plan.rindex("HashAggregate(keys=[k")


def test_row_checks_of_one_table_share_one_aggregate(spark, tmp_path):
    path = str(tmp_path / "uf")
    silver.build(silver.UF, bronze(spark, silver.UF, [])).write.parquet(path)
    specs = [c for c in quality.CHECKS if c.table == "uf" and c.fails is not None]
    plan = plan_of(run_checks({"uf": spark.read.parquet(path)}, specs))
    assert plan.count("FileScan") == 1


def test_the_execution_time_is_utc_text_whatever_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        (row,) = {r.execution_timestamp_utc for r in quality.validation_results(_tables(spark)).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert abs(datetime.fromisoformat(row) - datetime.now(timezone.utc).replace(tzinfo=None)) < timedelta(minutes=5)


def test_measured_row_checks_read_no_table_and_equal_the_scanned_ones(spark, tmp_path):
    specs = [c for c in quality.CHECKS if c.fails is not None]
    tables = {}
    for spec in silver.SILVER:
        path = str(tmp_path / spec.name)
        silver.build(spec, bronze(spark, spec, [])).write.parquet(path)
        tables[spec.name] = spark.read.parquet(path)
    measured = {}
    for name, table in tables.items():
        seen = Observation(f"measured-{name}")
        table.observe(seen, *row_measures(quality.row_checks_of(name))).write.format("noop").mode("overwrite").save()
        measured[name] = seen.get
    stamp = F.lit("t")
    found = run_checks(tables, specs, stamp, measured)
    assert "FileScan" not in plan_of(found)
    assert sorted(map(str, found.collect())) == sorted(map(str, run_checks(tables, specs, stamp).collect()))
    assert {r.failed_records for r in found.collect()} == {None}  # empty tables: no count, as when they are scanned
    some = {"uf": {"total_records": 8, **{c.name: 2 for c in specs if c.table == "uf"}}}
    rows = [r for r in run_checks(tables, specs, stamp, some).collect() if r.table_name == "uf"]
    assert {(r.total_records, r.failed_records, r.failed_pct, r.status) for r in rows} == {(8, 2, 25.0, "FAIL")}
