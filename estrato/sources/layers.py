"""Reading and writing lake tables."""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from estrato.config import LakeConfig
from estrato.session import child_folders, path_exists, read_text, switch_folder, write_text

PARTITION = "_ingestion_date"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
SCHEMA_FILE = "_schema.json"  # Spark's readers skip names with a leading underscore


def _kept_fields(spark: SparkSession, path: str) -> list[T.StructField]:
    """The columns of the table at ``path``; none where there is no table or an empty folder."""
    if not path_exists(spark, path):
        return []
    try:
        return read_table(spark, path).schema.fields
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return []


def _keep_schema(df: DataFrame, path: str, earlier: list[T.StructField]) -> None:
    """Record the columns of ``df`` and of ``earlier`` files in the order a reader finds them: the partition column last."""
    new = {f.name.lower(): f for f in df.schema.fields}
    old = [f for f in earlier if f.name.lower() not in new]
    fields = sorted([*df.schema.fields, *old], key=lambda f: f.name == PARTITION)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    write_text(df.sparkSession, f"{path.rstrip('/')}/{SCHEMA_FILE}", schema.json())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, with the ingestion date as the text that was written.

    Spark would read the partition folder's value back as a date; the declared schema keeps it text, and
    filters on it still prune folders. Tables written here carry their schema in a file beside the data, so planning
    a read runs no job.
    """
    known = read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    if known is not None:
        return spark.read.schema(T.StructType.fromJson(json.loads(known))).parquet(path)
    found = spark.read.parquet(path).schema
    if PARTITION not in found.names:
        return spark.read.schema(found).parquet(path)
    text = T.StringType()
    declared = T.StructType([T.StructField(f.name, text if f.name == PARTITION else f.dataType) for f in found])
    return spark.read.schema(declared).parquet(path)


def stream_table(table: str) -> str:
    """The bronze table of a stream that feeds the same silver table as the batch table ``table``."""
    return f"{table}_stream"


def read_layer(spark: SparkSession, cfg: LakeConfig, layer: str, table: str) -> DataFrame:
    return read_table(spark, cfg.path(layer, table))


def _registered(spark: SparkSession, name: str, path: str, partitioned: bool) -> T.StructType | None:
    """The columns of the catalog table ``name`` if it lies at ``path``, with or without partitions as asked."""
    if not spark.catalog.tableExists(name):
        return None
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    same_place = told.get("Location", "").split(":", 1)[-1].strip("/") == path.split(":", 1)[-1].strip("/")
    if not same_place or partitioned != ("# Partition Information" in told):
        return None
    return spark.table(name).schema


def _partition(day: str) -> str:
    return f"PARTITION ({PARTITION} = '" + day.replace("\\", "\\\\").replace("'", "\\'") + "')"


def register_table(spark: SparkSession, database: str, table: str, path: str, partitioned: bool) -> None:
    """Bring a catalog table in line with the Parquet files under ``path``; it is external, no file is touched.

    A table that is there stays there: new columns are added to it, dates that have appeared are added and dates whose
    folder is gone are dropped, so readers never find it missing and dates that stay are not listed again. Only if a
    column has gone or changed its type is the table made anew.
    """
    schema = read_table(spark, path).schema
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    known = _registered(spark, name, path, partitioned)
    types = {f.name: f.dataType for f in schema}
    if known is None or any(types.get(f.name) != f.dataType for f in known):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(
            f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet "
            + (f"PARTITIONED BY ({PARTITION}) " if partitioned else "")
            + "LOCATION '{}'".format(path.replace("\\", "\\\\").replace("'", "\\'"))
        )
    else:
        fresh = T.StructType([f for f in schema if f.name not in known.names])
        if fresh:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({fresh.toDDL()})")
    if partitioned:
        there = {d.partition("=")[2] for d in child_folders(spark, path) if d.startswith(f"{PARTITION}=")}
        listed = {r.partition.partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        for verb, days in (("ADD IF NOT EXISTS", there - listed), ("DROP IF EXISTS", listed - there)):
            days = sorted(unquote(d) for d in days if d != NO_DATE)
            for low in range(0, len(days), 500):
                some = [_partition(d) for d in days[low : low + 500]]
                joined = (" " if verb.startswith("ADD") else ", ").join(some)
                spark.sql(f"ALTER TABLE {name} {verb} {joined}")
        if NO_DATE in there - listed:  # rows without a date have a folder that SQL cannot name
            spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def write_bronze(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    preserve_history: bool = False,
    database: str | None = None,
    table: str | None = None,
    register: bool = False,
    many_dates: bool = False,
) -> None:
    """Write Snappy Parquet partitioned by ingestion date.

    ``overwrite`` replaces the whole table; with ``preserve_history`` only the dates in ``df``. Where earlier files
    stay, so do their columns: a column that ``df`` lacks is null in its rows. ``register``
    also records the table in the catalog. A batch has one date, or a handful, and is written as it is: each task
    writes a file per date it holds, and nothing is shuffled. ``many_dates`` first gathers rows by date, splitting large
    dates and merging small ones, so tasks do not write a file per date.
    """
    if register and not (database and table):
        raise ValueError("registering needs both database and table")
    if many_dates:
        df = df.hint("rebalance", PARTITION)
    writer = df.write.format("parquet").mode(mode).option("compression", "snappy").partitionBy(PARTITION)
    if preserve_history:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    whole = mode == "overwrite" and not preserve_history
    earlier = [] if whole else _kept_fields(df.sparkSession, path)
    writer.save(path)
    _keep_schema(df, path, earlier)
    if register:
        register_table(df.sparkSession, database, table, path, partitioned=True)


def write_layer(
    df: DataFrame, cfg: LakeConfig, layer: str, table: str, *, register: bool = False, partition: str | None = None
) -> str:
    """Replace one derived table as Snappy Parquet and return its path. Bronze is refused.

    Without ``partition``, the last column of ``df``, the table has no folders inside.

    The table is written aside and then takes the old one's place, so a failed write leaves the old table.
    """
    if partition and register:
        raise ValueError("a derived table in folders is not registered")
    path = cfg.path(layer, table)
    cfg.require_rebuildable(path)
    fresh = f"{path.rstrip('/')}.next-{uuid.uuid4().hex[:12]}"
    writer = df.write.format("parquet").option("compression", "snappy")
    (writer.partitionBy(partition) if partition else writer).save(fresh)
    derived = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    write_text(df.sparkSession, f"{fresh}/{SCHEMA_FILE}", derived.json())
    switch_folder(df.sparkSession, fresh, path)
    df.sparkSession.catalog.refreshByPath(path)
    if register:
        register_table(df.sparkSession, cfg.databases[layer], table, path, partitioned=False)
    return path
