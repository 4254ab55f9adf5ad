"""Keep silver tables current by folding in new bronze files only.

The newest row of a key is a maximum, so it can be taken of what is stored and what is new. A silver table kept this
way is stored in slices, folders by a hash of the key. A run reads the bronze files that no earlier run has read, finds
the slices their keys belong to, and rewrites those slices; all others stay as they are, files included. Which bronze
files a table holds is noted beside it. Where a noted file is gone, because a date was delivered anew or bronze was
replaced, rows may have to be taken back, which a maximum cannot do: the table is then built from all of bronze.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from estrato.config import LakeConfig
from estrato.plans import silver
from estrato.session import child_folders, data_files, path_exists, read_text, stage, write_text
from estrato.sources.layers import SCHEMA_FILE, read_layer, read_table, stream_table, write_layer
from estrato.sources.lineage import LINEAGE

logger = logging.getLogger(__name__)

SLICE = "_slice"
SLICES = 64  # folders of a table; a run rewrites those that its keys fall into
NOTES_FILE = "_folded.json"  # Spark's readers skip names with a leading underscore


@dataclass(frozen=True)
class FoldResult:
    """One run over one table: what was read and written."""

    table: str
    whole: bool  # built from all of bronze
    folders_read: int  # bronze folders with files that were read
    bronze_rows: int
    stored_rows: int  # rows of the stored table that were read
    slices_written: int
    rows_written: int
    path: str


def _slice(key: Sequence[str], slices: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(slices)).cast("int")


def _bronze_files(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Names of the data files of a bronze table by folder of a date, the table's own as the empty name."""
    if not path_exists(spark, path):
        return {}
    folders = ["", *[f for f in child_folders(spark, path) if "=" in f]]
    return {f: names for f in folders if (names := sorted(data_files(spark, f"{path}{f}")))}


def _fresh(spark: SparkSession, path: str, files: dict[str, list[str]], noted: dict[str, list[str]]) -> DataFrame | None:
    """The rows of the files that are not noted, None if there is no such file; a new folder is named as a whole."""
    new: list[str] = []
    for folder, names in files.items():
        known = noted.get(folder)
        new += [f"{path}{folder}"] if folder and not known else [
            f"{path}{folder}/{name}" for name in set(names) - set(known or ())
        ]
    if not new:
        return None
    schema = read_table(spark, path).schema
    return spark.read.schema(schema).option("basePath", path).parquet(*sorted(new))


def _counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def fold(
    spark: SparkSession, cfg: LakeConfig, spec: silver.SilverSpec, *, slices: int = SLICES
) -> FoldResult:
    """Bring one silver table up to date with its bronze tables, the batch's and the stream's.

    The result holds the same rows as a build from all of bronze, with the column ``_slice`` beside them. A run that
    finds no new file reads and writes no rows. The new slices are staged, then take the old ones' places; the notes
    come last, so a run that fails before is made up for by the next one, which folds the same rows in again.
    """
    sources = [cfg.path("bronze", name) for name in (spec.name, stream_table(spec.name))]
    path = cfg.path("silver", spec.name)
    cfg.require_rebuildable(path)
    notes = json.loads(read_text(spark, f"{path}{NOTES_FILE}") or "{}")
    files = {source: _bronze_files(spark, source) for source in sources}
    known = notes.get("files", {})
    gone = any(
        set(names) - set(files.get(source, {}).get(folder, ()))
        for source, folders in known.items()
        for folder, names in folders.items()
    )
    whole = gone or notes.get("slices") != slices or notes.get("key") != list(spec.key)
    known = {} if whole else known
    fresh = {source: _fresh(spark, source, files[source], known.get(source, {})) for source in sources}
    found = [rows for rows in fresh.values() if rows is not None]
    if not found:
        if whole:
            raise ValueError(f"no bronze files for {spec.name}")
        return FoldResult(spec.name, False, 0, 0, 0, 0, 0, path)
    folders = sum(
        bool(set(names) - set(known.get(source, {}).get(folder, ())))
        for source in sources
        for folder, names in files[source].items()
    )

    new, read = _counted(silver.typed(spec, *found), f"fold-{spec.name}-new")
    made = silver.newest(spec, new).withColumn(SLICE, _slice(spec.key, slices))
    stored_rows = 0
    if not whole:
        # The slices are a bounded list of numbers; the filter prunes folders.
        made = stage(made, f"fold-{spec.name}-new")
        touched = sorted(r[0] for r in made.select(SLICE).distinct().collect())
        columns = [c.name for c in spec.casts] + list(LINEAGE)
        stored = read_layer(spark, cfg, "silver", spec.name).where(F.col(SLICE).isin(touched))
        old, old_read = _counted(stored.select(columns), f"fold-{spec.name}-old")
        both = old.unionByName(made.select(columns))
        made = silver.newest(spec, both).withColumn(SLICE, _slice(spec.key, slices))
    # Staged first: a slice is read and replaced, and a failing run leaves the table as it was.
    made, written = _counted(made, f"fold-{spec.name}-out")
    made = stage(made.repartition(SLICE), f"fold-{spec.name}")
    if whole:
        touched = list(range(slices))
        write_layer(made, cfg, "silver", spec.name, partition=SLICE)
    else:
        stored_rows = old_read.get["rows"]
        writer = made.write.mode("overwrite").option("compression", "snappy").partitionBy(SLICE)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        write_text(spark, f"{path}{SCHEMA_FILE}", made.schema.json())
        spark.catalog.refreshByPath(path)
    write_text(spark, f"{path}{NOTES_FILE}", json.dumps({"slices": slices, "key": list(spec.key), "files": files}))
    result = FoldResult(
        spec.name, whole, folders, read.get["rows"], stored_rows, len(touched), written.get["rows"], path
    )
    logger.info("%s", result)
    return result


def fold_silver(
    spark: SparkSession, cfg: LakeConfig, *, tables: Sequence[str] | None = None, slices: int = SLICES
) -> list[FoldResult]:
    """``fold`` for all six tables, or those named."""
    return [fold(spark, cfg, spec, slices=slices) for spec in silver.SILVER if tables is None or spec.name in tables]
