"""Registered queries: one per operator, report and round trip, each with a DuckDB statement beside it."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import partial, reduce, wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402
from estrato.config import LakeConfig, SourceSpec  # noqa: E402
from estrato.functions.measures import (  # noqa: E402
    bucketize,
    business_key,
    gap,
    target_for_year,
)
from estrato.operators.checks import duplicate_groups, orphan_rows, row_checks  # noqa: E402
from estrato.operators.evolution import evolution  # noqa: E402
from estrato.operators.latest import latest_by_key  # noqa: E402
from estrato.operators.ranking import rank_within  # noqa: E402
from estrato.operators.rollup import sample_rollup  # noqa: E402
from estrato.operators.standardize import standardize  # noqa: E402
from estrato.operators.territory import with_region, with_territory  # noqa: E402
from estrato.plans import gold, quality, reports, silver, starschema  # noqa: E402
from estrato.plans.incremental import fold  # noqa: E402
from estrato.plans.layers import run_layer  # noqa: E402
from estrato.session import new_folder, path_exists, run_at_once, stage, use_shared_folder  # noqa: E402
from estrato.sources.batch import ingest  # noqa: E402
from estrato.sources.layers import read_layer, read_table, stream_table, write_bronze  # noqa: E402
from estrato.sources.lineage import LINEAGE, add_batch_lineage, add_stream_lineage, execution_id  # noqa: E402
from estrato.streaming.events import FIELDS, parse_events, split_valid  # noqa: E402
from estrato.streaming.ingest import bronze_sink, parquet_mirror, start_ingest  # noqa: E402
from estrato.streaming.newest import newest_only  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    import estrato.llm.queries as llm  # noqa: E402
except ModuleNotFoundError as missing:  # the rest works without that subpackage
    if not (missing.name or "").startswith(("estrato.llm", "corpus_pipeline", "public_tokenizers")):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

# One fixed clock, so results that carry lineage can be compared.
AT = datetime(2024, 5, 1, 9, 30, tzinfo=timezone(timedelta(hours=-3)))

# Tables of a layer that are built or stored at a time.
AT_ONCE = 3

Query = Callable[[SparkSession, str], DataFrame]


def _clock() -> datetime:
    return AT


def _bronze(spec: silver.SilverSpec) -> Query:
    return lambda spark, sf_dir: starschema.bronze(spark, sf_dir, spec.name)


def _typed(spec: silver.SilverSpec) -> Query:
    return lambda spark, sf_dir: standardize(_bronze(spec)(spark, sf_dir), spec.casts, passthrough=LINEAGE)


def _silver(spec: silver.SilverSpec) -> Query:
    return lambda spark, sf_dir: silver.build(spec, _bronze(spec)(spark, sf_dir))


def _staged(spec: silver.SilverSpec) -> Query:
    return lambda spark, sf_dir: stage(_silver(spec)(spark, sf_dir), f"silver-{spec.name}")


def _valid_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(silver.MUNICIPIO)(spark, sf_dir).filter(
        "flag_id_municipio_valido AND flag_taxa_alfabetizacao_valida"
    )


def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = silver.ALUNOS
    rules = [rule().alias(name) for name, rule in spec.flags.items()]
    return _typed(spec)(spark, sf_dir).select(*spec.key, *rules, "_execution_id")


def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = silver.ALUNOS
    return _typed(spec)(spark, sf_dir).select(business_key(*spec.key).alias("chave"), "_execution_id")


def keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = silver.ALUNOS
    return latest_by_key(_typed(spec)(spark, sf_dir), spec.key, silver.newest_first(), names_rows=spec.names_rows)


def territory_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = silver.MUNICIPIO
    places = _silver(spec)(spark, sf_dir).select(spec.key_name, "id_municipio")
    return with_territory(places, "id_municipio")


def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = silver.UF
    return with_region(_silver(spec)(spark, sf_dir).select(spec.key_name, "sigla_uf"), "sigla_uf")


def student_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rollup(_silver(silver.ALUNOS)(spark, sf_dir), ["ano", "id_municipio", "serie", "rede"])


def target_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = silver.META_MUNICIPIO
    rate, target = F.col("taxa_alfabetizacao_pct"), F.col("meta_ano_pct")
    return (
        _silver(spec)(spark, sf_dir)
        .withColumn("meta_ano_pct", target_for_year("ano", silver.TARGET_COLUMNS))
        .select(
            spec.key_name,
            "ano",
            rate,
            target,
            gap(rate, target).alias("diferenca_meta_ano_pp"),
            gold.annual_status(rate, target).alias("status_meta_ano"),
        )
    )


def priority_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = F.col("taxa_alfabetizacao_pct")
    return _valid_places(spark, sf_dir).select(
        silver.MUNICIPIO.key_name, rate, bucketize(rate, gold.PRIORITY_BOUNDS, gold.PRIORITY_LABELS).alias("faixa")
    )


def year_on_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _valid_places(spark, sf_dir).select("ano", "id_municipio", "serie", "rede", "taxa_alfabetizacao_pct")
    return evolution(
        stage(places, "year-on-year"),
        "taxa_alfabetizacao_pct",
        partition=["id_municipio", "rede"],
        period="ano",
        tiebreak=["serie"],
        previous="taxa_anterior_pct",
        change="variacao_pp",
    )


def year_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _silver(silver.MUNICIPIO)(spark, sf_dir).select(
        "ano", "id_municipio", "serie", "rede", "taxa_alfabetizacao_pct"
    )
    return rank_within(stage(places, "year-rank"), ["ano"], "taxa_alfabetizacao_pct", output="posicao")


def indicador_municipio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.indicador_municipio(
        _silver(silver.MUNICIPIO)(spark, sf_dir), _silver(silver.ALUNOS)(spark, sf_dir)
    )


def metas_vs_resultados_municipio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.metas_vs_resultados_municipio(
        _silver(silver.MUNICIPIO)(spark, sf_dir), _silver(silver.META_MUNICIPIO)(spark, sf_dir)
    )


def evolucao_alfabetizacao_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The target tables are read twice, as stored silver tables would be.
    return gold.evolucao_alfabetizacao_uf(
        _silver(silver.UF)(spark, sf_dir),
        _staged(silver.META_UF)(spark, sf_dir),
        _staged(silver.META_BRASIL)(spark, sf_dir),
    )


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(_typed(silver.ALUNOS)(spark, sf_dir), silver.ALUNOS.key)


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_rows(
        _typed(silver.ALUNOS)(spark, sf_dir), _typed(silver.MUNICIPIO)(spark, sf_dir), "id_municipio"
    )


def student_row_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [c for c in quality.CHECKS if c.table == "alunos" and c.fails is not None]
    return row_checks(_silver(silver.ALUNOS)(spark, sf_dir), specs)


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {s.name: _staged(s)(spark, sf_dir) for s in silver.SILVER}
    return quality.validation_results(tables, executed_at=F.lit(AT.isoformat()))


def below_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.municipalities_below_target(metas_vs_resultados_municipio(spark, sf_dir))


def best_evolving_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.best_evolving_states(evolucao_alfabetizacao_uf(spark, sf_dir))


def regional_inequality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.regional_inequality(evolucao_alfabetizacao_uf(spark, sf_dir))


def _broker_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return starschema.broker_events(spark, starschema.table(spark, sf_dir, "events"))


def event_parse_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(_broker_events(spark, sf_dir)).drop("value")


def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split_valid(parse_events(_broker_events(spark, sf_dir)))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("eventos"))


def stream_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = split_valid(parse_events(_broker_events(spark, sf_dir)))
    return add_stream_lineage(accepted, "uf", AT).select(*FIELDS, *LINEAGE)


def _run_stream(spark: SparkSession, sf_dir: str, label: str) -> tuple[LakeConfig, str]:
    """Stream the events table into a mirror, bronze and a folder of rejects; return the lake and the common folder."""
    folder = new_folder(spark, label)
    cfg = LakeConfig(root=f"{folder}/lake", environment="prod")

    def rejects(batch: DataFrame, batch_id: int) -> None:
        batch.drop("value").write.mode("append").parquet(f"{folder}/rejects")

    events = starschema.broker_events(spark, starschema.event_stream(spark, sf_dir))
    query = start_ingest(
        events,
        f"{folder}/checkpoint",
        mirror=parquet_mirror(f"{folder}/mirror"),
        bronze=bronze_sink(cfg, "uf", _clock),
        rejects=rejects,
        available_now=True,
    )
    query.awaitTermination()
    return cfg, folder


def stream_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, _ = _run_stream(spark, sf_dir, "stream-ingest")
    return silver.build(silver.UF, read_layer(spark, cfg, "bronze", stream_table("uf")))


def batch_and_stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, _ = _run_stream(spark, sf_dir, "batch-and-stream")
    streamed = read_layer(spark, cfg, "bronze", stream_table("uf"))
    return silver.build(silver.UF, _bronze(silver.UF)(spark, sf_dir), streamed)


def shared_bronze_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch rows with text columns and typed stream rows, both stored; the silver layer is rebuilt from the store."""
    cfg, _ = _run_stream(spark, sf_dir, "shared-bronze")
    delivered = {spec.name: _bronze(spec)(spark, sf_dir) for spec in silver.SILVER}
    delivered["uf"] = delivered["uf"].select([F.col(name).cast("string") for name in delivered["uf"].columns])
    _write_deliveries(spark, cfg, delivered)
    run_layer(spark, cfg, "silver", at_once=AT_ONCE)
    return read_layer(spark, cfg, "silver", "uf")


def reject_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = _run_stream(spark, sf_dir, "rejects")
    return read_table(spark, f"{folder}/rejects")


def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bronze table written with registration and read through the catalog."""
    spec = silver.META_BRASIL
    where = {"database": "bronze_catalog", "table": spec.name, "register": True}
    write_bronze(_bronze(spec)(spark, sf_dir), new_folder(spark, "catalog"), many_dates=True, **where)
    typed = standardize(spark.table(f"bronze_catalog.{spec.name}"), spec.casts, passthrough=LINEAGE)
    return latest_by_key(typed, spec.key, silver.newest_first())


def stream_mirror_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, folder = _run_stream(spark, sf_dir, "stream-mirror")
    return read_table(spark, f"{folder}/mirror").select(*FIELDS)


def stream_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only events that may be the newest of their key, in shuffled micro-batches, with a restart and all of them again."""
    folder = new_folder(spark, "stream-newest")
    cfg = LakeConfig(root=f"{folder}/lake", environment="prod")
    events = starschema.table(spark, sf_dir, "events")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3).option("recursiveFileLookup", True)
    for delivery in ("first", "second"):
        events.repartition(9, F.xxhash64("event_id")).write.parquet(f"{folder}/events/{delivery}")
        query = start_ingest(
            newest_only(starschema.broker_events(spark, source.parquet(f"{folder}/events")), silver.UF.key),
            f"{folder}/checkpoint",
            bronze=bronze_sink(cfg, "uf", _clock),
            available_now=True,
        )
        query.awaitTermination()
    return silver.build(silver.UF, read_layer(spark, cfg, "bronze", stream_table("uf")))


def stream_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mirror after the whole stream came twice; its ledger knows what was written."""
    folder = new_folder(spark, "redelivery")
    mirror = parquet_mirror(f"{folder}/mirror", ledger=f"{folder}/ledger")
    for delivery in ("first", "second"):
        events = starschema.broker_events(spark, starschema.event_stream(spark, sf_dir))
        query = start_ingest(events, f"{folder}/{delivery}", mirror=mirror, available_now=True)
        query.awaitTermination()
    return read_table(spark, f"{folder}/mirror").select(*FIELDS)


# Years of arrival of three deliveries that are folded into silver one after the other.
DELIVERIES = (("0000", "1997"), ("1998", "1999"), ("2000", "9999"))


def _fold_deliveries(spark: SparkSession, sf_dir: str, label: str):
    """Each delivery with what folding it did, and the lake."""
    spec = silver.MUNICIPIO
    cfg = LakeConfig(root=new_folder(spark, label), environment="prod")
    year = F.substring("_ingestion_date", 1, 4)
    done = []
    for first, last in DELIVERIES:
        rows = _bronze(spec)(spark, sf_dir).where(year.between(first, last))
        write_bronze(rows, cfg.path("bronze", spec.name), preserve_history=True, many_dates=True)
        done.append((rows, fold(spark, cfg, spec, slices=8)))
    return cfg, done


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, _ = _fold_deliveries(spark, sf_dir, "incremental")
    return read_layer(spark, cfg, "silver", silver.MUNICIPIO.name).drop("_slice")


def incremental_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and dates that arrived with each delivery beside those that folding it read."""
    _, done = _fold_deliveries(spark, sf_dir, "incremental-report")
    reports_ = [
        rows.agg(
            F.lit(number).alias("entrega"),
            F.count(F.lit(1)).alias("linhas"),
            F.count_distinct("_ingestion_date").alias("datas"),
            F.lit(result.bronze_rows).cast("bigint").alias("linhas_lidas"),
            F.lit(result.folders_read).cast("bigint").alias("datas_lidas"),
            F.lit(result.whole).alias("completa"),
        )
        for number, (rows, result) in enumerate(done, 1)
    ]
    return reduce(DataFrame.unionByName, reports_)


def step_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of the silver layer read, beside the stored bronze table and the sizes of its files."""
    cfg = _bronze_lake(spark, sf_dir, "statistics")
    rows = []
    for step in run_layer(spark, cfg, "silver", at_once=AT_ONCE):
        path = cfg.path("bronze", step.table)
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        sizes = files.agg((F.sum("length") == step.bytes_read).alias("bytes_conferem"))
        counted = read_layer(spark, cfg, "bronze", step.table).agg(
            F.lit(step.table).alias("tabela"),
            F.count(F.lit(1)).alias("linhas_bronze"),
            F.lit(step.engine.rows_scanned).cast("bigint").alias("linhas_varridas"),
            F.lit(0 < step.engine.bytes_scanned).alias("com_bytes_varridos"),
            F.lit(step.engine.engine_ms > 0).alias("com_tempo"),
        )
        rows.append(counted.withColumn("um", F.lit(1)).join(sizes.withColumn("um", F.lit(1)), "um").drop("um"))
    return reduce(DataFrame.unionByName, rows)


def catalog_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered bronze table that grows by dates, read through the catalog."""
    spec = silver.META_BRASIL
    path = new_folder(spark, "catalog-dates")
    year = F.substring("_ingestion_date", 1, 4)
    for first, last in DELIVERIES:
        rows = _bronze(spec)(spark, sf_dir).where(year.between(first, last))
        where = {"database": "bronze_catalog", "table": f"{spec.name}_by_date", "register": True}
        write_bronze(rows, path, preserve_history=True, many_dates=True, **where)
    typed = standardize(spark.table(f"bronze_catalog.{spec.name}_by_date"), spec.casts, passthrough=LINEAGE)
    return latest_by_key(typed, spec.key, silver.newest_first())


def batch_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = starschema.table(spark, sf_dir, "orders")
    return add_batch_lineage(orders, "pedidos", "vendas", "orders", execution_id(AT), AT)


def _source(sf_dir: str, name: str, **fields: object) -> SourceSpec:
    return SourceSpec(name, "vendas", name, name, "parquet", {"path": f"{sf_dir}/{name}.parquet"}, **fields)


def bronze_batch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = LakeConfig(root=new_folder(spark, "batch-ingest"), environment="prod")
    sources = [_source(sf_dir, "customer"), _source(sf_dir, "supplier"), _source(sf_dir, "part", load_enabled=False)]
    ingest(spark, cfg, sources, clock=_clock)
    loaded = [read_layer(spark, cfg, "bronze", name) for name in ("customer", "supplier")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), loaded)


def bronze_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "partitioned")
    events = starschema.table(spark, sf_dir, "events")
    dated = events.withColumn("_ingestion_date", F.date_format("ts", "yyyy-MM-dd"))
    write_bronze(dated, path, many_dates=True)
    return read_table(spark, path)


def _write_deliveries(spark: SparkSession, cfg: LakeConfig, delivered: dict[str, DataFrame]) -> None:
    """Store bronze tables that have one date of delivery a year."""
    writes = [partial(write_bronze, rows, cfg.path("bronze", name)) for name, rows in delivered.items()]
    run_at_once(spark, writes, AT_ONCE)


def _bronze_lake(spark: SparkSession, sf_dir: str, label: str) -> LakeConfig:
    cfg = LakeConfig(root=new_folder(spark, label), environment="prod")
    _write_deliveries(spark, cfg, {spec.name: _bronze(spec)(spark, sf_dir) for spec in silver.SILVER})
    return cfg


def _stored(layer: str, table: str) -> Query:
    """The content of a derived table after all layers up to its own were rebuilt and stored."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = _bronze_lake(spark, sf_dir, f"stored-{table}")
        for name in ("silver", layer):
            run_layer(spark, cfg, name, at_once=AT_ONCE)
        stored = read_layer(spark, cfg, layer, table)
        if "execution_timestamp_utc" not in stored.columns:
            return stored
        age = F.current_timestamp().cast("double") - F.to_timestamp("execution_timestamp_utc").cast("double")
        return stored.withColumn("carimbo_recente", age.between(0, 3600)).drop("execution_timestamp_utc")

    return run


def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plans of the silver layer over a stored bronze layer; none is run."""
    cfg = _bronze_lake(spark, sf_dir, "dry-run")
    steps = run_layer(spark, cfg, "silver", dry_run=True)
    rows = [
        read_layer(spark, cfg, "bronze", step.table).agg(
            F.lit(step.table).alias("tabela"),
            F.count(F.lit(1)).alias("linhas_bronze"),
            F.lit("Physical Plan" in step.plan and step.rows is None).alias("so_planejada"),
            F.lit(path_exists(spark, cfg.path("silver", step.table))).alias("gravada"),
        )
        for step in steps
    ]
    return reduce(DataFrame.unionByName, rows)


def rebuild_all_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _bronze_lake(spark, sf_dir, "rebuild")
    counts = []
    for layer in ("silver", "gold", "quality"):
        for done in run_layer(spark, cfg, layer, at_once=AT_ONCE):
            rows = F.count(F.lit(1)).alias("linhas")
            counts.append(
                read_table(spark, done.path).agg(
                    F.lit(layer).alias("camada"),
                    F.lit(done.table).alias("tabela"),
                    rows,
                    F.lit(done.rows).cast("bigint").alias("linhas_informadas"),
                    F.lit(done.seconds > 0).alias("com_tempo"),
                )
            )
    return reduce(DataFrame.unionByName, counts)


def measured_quality_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored report whose row checks were measured while the silver tables were written."""
    cfg = _bronze_lake(spark, sf_dir, "measured")
    run_layer(spark, cfg, "quality", measured=run_layer(spark, cfg, "silver", at_once=AT_ONCE))
    return read_layer(spark, cfg, "quality", "validation_results").drop("execution_timestamp_utc")


def _with_folder(query: Query) -> Query:
    """``query`` in a session that may leave ``spark.checkpoint.dir`` unset: the warehouse is shared as well."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if not spark.conf.get("spark.checkpoint.dir", None):
            use_shared_folder(spark, f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged")
        return query(spark, sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """State results over the years, from raw rows to the gold table."""
    return _with_folder(evolucao_alfabetizacao_uf)(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    found = {
        "safe_cast": _typed(silver.ALUNOS),
        "key_normalisation": _typed(silver.META_UF),
        "quality_flags": quality_flags,
        "business_key": composite_key,
        "keep_latest": keep_latest,
        **{f"silver_{spec.name}": _silver(spec) for spec in silver.SILVER},
        "territory_lookup": territory_lookup,
        "region_lookup": region_lookup,
        "sample_rollup": student_rollup,
        "target_of_year": target_of_year,
        "priority_band": priority_band,
        "year_on_year": year_on_year,
        "year_rank": year_rank,
        "gold_indicador_municipio": indicador_municipio,
        "gold_metas_vs_resultados_municipio": metas_vs_resultados_municipio,
        "gold_evolucao_alfabetizacao_uf": evolucao_alfabetizacao_uf,
        "duplicate_groups": duplicates,
        "orphan_rows": orphans,
        "row_checks": student_row_checks,
        "quality_checks": quality_checks,
        "below_target": below_target,
        "best_evolving_states": best_evolving_states,
        "regional_inequality": regional_inequality,
        "event_parse_validate": event_parse_validate,
        "event_rejects": event_rejects,
        "stream_lineage": stream_lineage,
        "stream_ingest_roundtrip": stream_ingest_roundtrip,
        "stream_mirror_roundtrip": stream_mirror_roundtrip,
        "stream_redelivery": stream_redelivery,
        "stream_newest": stream_newest,
        "batch_and_stream_silver": batch_and_stream_silver,
        "shared_bronze_silver": shared_bronze_silver,
        "reject_roundtrip": reject_roundtrip,
        "catalog_roundtrip": catalog_roundtrip,
        "catalog_by_date": catalog_by_date,
        "incremental_silver": incremental_silver,
        "incremental_report": incremental_report,
        "step_statistics": step_statistics,
        "batch_lineage": batch_lineage,
        "bronze_batch_ingest": bronze_batch_ingest,
        "bronze_partitioned_roundtrip": bronze_partitioned_roundtrip,
        "rebuild_all_layers": rebuild_all_layers,
        "stored_gold_metas": _stored("gold", "metas_vs_resultados_municipio"),
        "stored_gold_evolucao": _stored("gold", "evolucao_alfabetizacao_uf"),
        "stored_quality_results": _stored("quality", "validation_results"),
        "measured_quality_results": measured_quality_results,
        "dry_run": dry_run,
        **(llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}),
    }
    return {name: _with_folder(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return oracle.statements() | (llm.oracle_sql() if llm else {})
