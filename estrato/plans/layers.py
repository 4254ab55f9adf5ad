"""Rebuild derived layers in order."""

from __future__ import annotations

import io
import logging
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager, redirect_stdout
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession

from estrato.config import LakeConfig
from estrato.operators.checks import Measures, row_measures
from estrato.plans import gold, quality, silver
from estrato.session import file_bytes, path_exists, run_at_once, stage
from estrato.sources.layers import read_layer, stream_table, write_layer

logger = logging.getLogger(__name__)

ReadTable = Callable[[str, str], list[DataFrame]]


@dataclass(frozen=True)
class Step:
    """One derived table and how it is built from tables read by (layer, name)."""

    layer: str
    table: str
    build: Callable[[ReadTable, gold.Keep, Mapping[str, Measures]], DataFrame]


@contextmanager
def job_group(spark: SparkSession, group: str) -> Iterator[None]:
    """Run the jobs started inside under a group of their own; the caller's group comes back afterwards."""
    context = spark.sparkContext
    names = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
    before = [(name, context.getLocalProperty(name)) for name in names]
    context.setJobGroup(group, group)
    try:
        yield
    finally:
        for name, value in before:
            context.setLocalProperty(name, value)


@dataclass(frozen=True)
class EngineStats:
    """Sums over all tasks of a step: bytes and rows scanned and written, bytes shuffled, milliseconds of run time."""

    bytes_scanned: int
    rows_scanned: int
    bytes_written: int
    bytes_shuffled: int
    engine_ms: int


def engine_stats(spark: SparkSession, group: str) -> EngineStats:
    """What the jobs of a job group did, from Spark's own record of their stages.

    Scanned bytes are those that tasks took from storage, so columns and row groups that a scan skips do not count.
    A stage that several jobs share counts once, one that was not needed not at all.
    """
    context = spark._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group)]
    totals = [0, 0, 0, 0, 0]
    for stage_id in sorted({s for job in jobs if job for s in job.stageIds}):
        if tracker.getStageInfo(stage_id) is None:
            continue
        done = context.statusStore().lastStageAttempt(stage_id)
        if done.numCompleteTasks():
            own = (
                done.inputBytes(), done.inputRecords(), done.outputBytes(), done.shuffleWriteBytes(),
                done.executorRunTime(),
            )
            totals = [a + b for a, b in zip(totals, own)]
    return EngineStats(*totals)


@dataclass(frozen=True)
class StepResult:
    layer: str
    table: str
    rows: int | None
    seconds: float
    path: str | None
    plan: str | None = None
    bytes_read: int | None = None  # sizes of the stored files the step reads, each file once
    engine: EngineStats | None = None  # what its tasks did
    measured: Measures | None = None  # numbers of the row checks, taken from the rows as they were written


def _one(read: ReadTable, table: str) -> DataFrame:
    return read("silver", table)[0]


def _silver_step(spec: silver.SilverSpec) -> Step:
    return Step("silver", spec.name, lambda read, keep, measured: silver.build(spec, *read("bronze", spec.name)))


STEPS = {
    "silver": tuple(_silver_step(spec) for spec in silver.SILVER),
    "gold": (
        Step(
            "gold",
            "indicador_municipio",
            lambda read, keep, measured: gold.indicador_municipio(_one(read, "municipio"), _one(read, "alunos")),
        ),
        Step(
            "gold",
            "metas_vs_resultados_municipio",
            lambda read, keep, measured: gold.metas_vs_resultados_municipio(
                _one(read, "municipio"), _one(read, "meta_alfabetizacao_municipio")
            ),
        ),
        Step(
            "gold",
            "evolucao_alfabetizacao_uf",
            lambda read, keep, measured: gold.evolucao_alfabetizacao_uf(
                _one(read, "uf"),
                _one(read, "meta_alfabetizacao_uf"),
                _one(read, "meta_alfabetizacao_brasil"),
                keep,
            ),
        ),
    ),
    "quality": (
        Step(
            "quality",
            "validation_results",
            lambda read, keep, measured: quality.validation_results(
                {s.name: _one(read, s.name) for s in silver.SILVER}, measured=measured
            ),
        ),
    ),
}


def _unstored(df: DataFrame, label: str) -> DataFrame:
    return df


def _plan_text(df: DataFrame) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def run_layer(
    spark: SparkSession,
    cfg: LakeConfig,
    layer: str,
    *,
    dry_run: bool = False,
    register: bool = False,
    more_bronze: Mapping[str, Sequence[str]] | None = None,
    measured: Sequence[StepResult] = (),
    at_once: int = 1,
) -> list[StepResult]:
    """Rebuild every table of ``layer`` in order; the first failure stops the run.

    The tables of a layer do not read each other: up to ``at_once`` of them are built at a time. With more than one,
    a step's seconds include waiting for cores, and steps under way when another fails are finished.

    A dry run returns the plan of each table, runs no job and writes nothing. Row counts come from the write
    itself, engine figures from Spark's record of the step's jobs. A stream's bronze table feeds the silver table of
    its name by itself; ``more_bronze`` names further ones.

    The write of a silver table also measures its row checks. With the results of that run as ``measured``, the
    quality layer reports them without reading the tables again; give only results of the tables as they are now.
    """
    if layer not in STEPS:
        raise ValueError(f"no steps for layer {layer!r}; known: {sorted(STEPS)}")

    numbers = {r.table: r.measured for r in measured if r.layer == "silver" and r.measured is not None}

    def read_into(inputs: dict[str, list[str]], source_layer: str, table: str) -> list[DataFrame]:
        names = [table]
        if source_layer == "bronze":
            streamed = stream_table(table)
            names += [streamed] if path_exists(spark, cfg.path("bronze", streamed)) else []
            names += (more_bronze or {}).get(table, ())
        frames = [read_layer(spark, cfg, source_layer, name) for name in names]
        if not dry_run:
            inputs.update({f"{source_layer}.{name}": df.inputFiles() for name, df in zip(names, frames)})
        return frames

    def run(step: Step) -> StepResult:
        started = time.monotonic()
        inputs: dict[str, list[str]] = {}
        read = partial(read_into, inputs)
        if dry_run:
            plan = _plan_text(step.build(read, _unstored, numbers))
            logger.info("dry run: %s.%s\n%s", layer, step.table, plan)
            return StepResult(layer, step.table, None, time.monotonic() - started, None, plan)
        group = f"{layer}.{step.table}-{uuid.uuid4().hex[:12]}"
        with job_group(spark, group):
            seen = Observation(f"{layer}_{step.table}")
            # Nothing is shuffled between here and the files, so a task that runs again is not counted again.
            checks = quality.row_checks_of(step.table) if layer == "silver" else []
            observed = step.build(read, stage, numbers).observe(seen, *row_measures(checks))
            path = write_layer(observed, cfg, layer, step.table, register=register)
        result = StepResult(
            layer,
            step.table,
            seen.get["total_records"],
            time.monotonic() - started,
            path,
            bytes_read=file_bytes(spark, {name for names in inputs.values() for name in names}),
            engine=engine_stats(spark, group),
            measured=dict(seen.get) if layer == "silver" else None,
        )
        logger.info(
            "%s.%s: %s rows in %.1f s; %s bytes in the files read, %s",
            layer, step.table, result.rows, result.seconds, result.bytes_read, result.engine,
        )
        return result

    if dry_run:
        at_once = 1  # plans are caught from standard output
    return run_at_once(spark, [partial(run, step) for step in STEPS[layer]], at_once)
