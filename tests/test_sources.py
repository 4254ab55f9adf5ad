import threading
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from estrato.config import LakeConfig, SourceSpec
from estrato.sources.batch import SOURCE_TABLES, default_sources, ingest, read_source
from estrato.sources.layers import read_layer, read_table, write_bronze, write_layer
from estrato.sources.lineage import LINEAGE, add_batch_lineage, execution_id

AT = datetime(2024, 5, 1, 23, 30, 1, tzinfo=timezone(timedelta(hours=-3)))


def _source(tmp_path, name, **fields):
    return SourceSpec(name, "dataset", f"{name}_id", f"{name}_raw", "parquet", {"path": str(tmp_path / name)}, **fields)


@pytest.fixture
def sources(spark, tmp_path):
    for name, rows in (("uf", 5), ("alunos", 2500)):
        spark.range(rows).write.parquet(str(tmp_path / name))
    return [_source(tmp_path, "uf"), _source(tmp_path, "alunos"), _source(tmp_path, "absent", load_enabled=False)]


def test_batch_lineage_is_local_time(spark):
    row = add_batch_lineage(spark.range(1), "uf", "dataset", "table", execution_id(AT), AT).first()
    assert tuple(row)[1:] == (
        "base_dos_dados", "uf", "dataset", "table", "2024-05-01T23:30:01-03:00", "2024-05-01", "20240501T233001Z",
    )


def test_ingest_loads_enabled_sources_with_one_run_id(spark, cfg, sources):
    written = ingest(spark, cfg, sources, clock=lambda: AT)
    assert list(written) == ["uf", "alunos"]
    uf = read_layer(spark, cfg, "bronze", "uf_raw")
    assert uf.columns == ["id", *[c for c in LINEAGE if c != "_ingestion_date"], "_ingestion_date"]
    assert uf.count() == 5
    assert {r._execution_id for r in uf.select("_execution_id").distinct().collect()} == {"20240501T233001Z"}
    assert read_layer(spark, cfg, "bronze", "alunos_raw").count() == 2500


@pytest.mark.parametrize("environment", ["dev", "prod"])
def test_ingest_of_one_source_reads_it_whole(spark, tmp_path, sources, environment):
    cfg = LakeConfig(root=str(tmp_path / "one-source"), environment=environment)
    assert list(ingest(spark, cfg, sources, only="alunos")) == ["alunos"]
    assert read_layer(spark, cfg, "bronze", "alunos_raw").count() == 2500


def test_the_first_failure_stops_the_run(spark, cfg, tmp_path, sources):
    missing = _source(tmp_path, "missing")
    with pytest.raises(Exception, match="missing"):
        ingest(spark, cfg, [missing, *sources])
    assert not (tmp_path / "lake").exists()


def test_an_empty_registry_is_an_error(spark, cfg):
    with pytest.raises(ValueError, match="empty"):
        ingest(spark, cfg, [])


def test_the_default_registry_has_the_six_tables():
    registry = default_sources("/export")
    assert tuple(s.name for s in registry) == SOURCE_TABLES
    assert registry[0].options == {"path": "/export/uf"}


def test_any_reader_can_be_a_source(spark, tmp_path):
    path = tmp_path / "uf.csv"
    path.write_text("ano;sigla_uf\n2024;SP\n")
    spec = SourceSpec("uf", "d", "t", "uf", "csv", {"path": str(path), "header": "true", "sep": ";"})
    assert [tuple(r) for r in read_source(spark, spec).collect()] == [("2024", "SP")]


def _dated(spark, day, value):
    return spark.createDataFrame([(value, day)], "x int, _ingestion_date string")


def test_overwrite_replaces_the_table_and_history_can_be_kept(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_bronze(_dated(spark, "2024-01-01", 1), path)
    write_bronze(_dated(spark, "2024-01-02", 2), path, preserve_history=True)
    write_bronze(_dated(spark, "2024-01-02", 3), path, preserve_history=True)
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [(1, "2024-01-01"), (3, "2024-01-02")]
    write_bronze(_dated(spark, "2024-01-03", 4), path, mode="append")
    assert read_table(spark, path).count() == 3
    write_bronze(_dated(spark, "2024-01-04", 5), path)
    assert [tuple(r) for r in read_table(spark, path).collect()] == [(5, "2024-01-04")]


@pytest.mark.parametrize("how", [{"mode": "append"}, {"preserve_history": True}])
def test_a_column_that_a_later_delivery_lacks_stays_readable(spark, tmp_path, how):
    path = str(tmp_path / "bronze")
    (tmp_path / "bronze").mkdir()
    write_bronze(_dated(spark, "2024-01-01", 1).withColumn("y", F.lit("old")), path, **how)
    write_bronze(_dated(spark, "2024-01-02", 2).withColumn("z", F.lit("new")), path, **how)
    rows = read_table(spark, path).select("x", "y", "z", "_ingestion_date").collect()
    assert sorted(map(tuple, rows)) == [(1, "old", None, "2024-01-01"), (2, None, "new", "2024-01-02")]
    write_bronze(_dated(spark, "2024-01-03", 3), path)
    assert read_table(spark, path).columns == ["x", "_ingestion_date"]


def test_the_ingestion_date_stays_text_and_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_bronze(_dated(spark, "2024-01-01", 1).union(_dated(spark, "2024-01-02", 2)), path, many_dates=True)
    table = read_table(spark, path)
    assert dict(table.dtypes)["_ingestion_date"] == "string"
    one = table.filter(F.col("_ingestion_date") == "2024-01-02")
    assert [r.x for r in one.collect()] == [2]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan


def test_files_are_snappy_parquet(spark, cfg, tmp_path):
    write_bronze(_dated(spark, "2024-01-01", 1), cfg.path("bronze", "t"))
    write_layer(spark.range(1), cfg, "silver", "t")
    for layer in ("bronze", "silver"):
        names = [p.name for p in (tmp_path / "lake" / "prod" / layer).rglob("part-*")]
        assert names and all(n.endswith(".snappy.parquet") for n in names)


def test_registering_needs_names_and_makes_a_table(spark, tmp_path):
    with pytest.raises(ValueError, match="database and table"):
        write_bronze(_dated(spark, "2024-01-01", 1), str(tmp_path / "t"), register=True)
    where = {"register": True, "database": "bronze_test", "table": "uf"}
    write_bronze(_dated(spark, "2024-01-01", 1), str(tmp_path / "t"), **where)
    write_bronze(_dated(spark, "2024-01-02", 2), str(tmp_path / "t"), preserve_history=True, **where)
    try:
        table = spark.table("bronze_test.uf")
        assert dict(table.dtypes)["_ingestion_date"] == "string"
        assert sorted(tuple(r) for r in table.collect()) == [(1, "2024-01-01"), (2, "2024-01-02")]
        wider = _dated(spark, "2024-01-03", 3).withColumn("y", F.lit("new"))
        write_bronze(wider, str(tmp_path / "t"), **where)
        assert [r.y for r in spark.table("bronze_test.uf").collect()] == ["new"]
    finally:
        spark.sql("DROP DATABASE bronze_test CASCADE")


def test_bronze_is_never_rebuilt(spark, cfg):
    with pytest.raises(ValueError, match="refusing"):
        write_layer(spark.range(1), cfg, "bronze", "uf")


def test_a_rebuilt_table_replaces_the_old_one(spark, cfg):
    write_layer(spark.range(10), cfg, "gold", "t")
    write_layer(spark.range(3).withColumn("y", F.lit(1)), cfg, "gold", "t")
    table = read_layer(spark, cfg, "gold", "t")
    assert (table.columns, table.count()) == (["id", "y"], 3)


def test_readers_never_miss_a_table_that_is_registered_again(spark, tmp_path):
    where = {"register": True, "database": "bronze_steady", "table": "t"}
    path = str(tmp_path / "t")
    write_bronze(_dated(spark, "2024-01-01", 1), path, **where)
    failed, stop, reads = [], threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                reads.append(spark.table("bronze_steady.t").where("_ingestion_date = '2024-01-01'").count())
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for day in range(2, 7):
            delivered = _dated(spark, f"2024-01-0{day}", day)
            if day > 3:
                delivered = delivered.withColumn("y", F.lit("new"))
            write_bronze(delivered, path, preserve_history=True, **where)
    finally:
        stop.set()
        reader.join()
    try:
        assert failed == [] and reads and set(reads) == {1}
        table = spark.table("bronze_steady.t")
        assert table.columns == ["x", "y", "_ingestion_date"]
        assert sorted((r.x, r.y) for r in table.collect()) == [(1, None), (2, None), (3, None), (4, "new"), (5, "new"), (6, "new")]
        odd = spark.createDataFrame([(7, None, "it's 100%"), (8, None, None)], "x int, y string, _ingestion_date string")
        write_bronze(odd, path, **where)
        assert sorted((r.x, r._ingestion_date) for r in spark.table("bronze_steady.t").collect()) == [(7, "it's 100%"), (8, None)]
    finally:
        spark.sql("DROP DATABASE bronze_steady CASCADE")
