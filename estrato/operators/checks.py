"""Declarative data-quality checks over a set of tables.

Checks on the rows of one table share a single aggregate, however many there are. Key and reference checks count
per key before anything else, so a hot key costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.functions.measures import pct

# Rows of a table as ``total_records`` and failures by name of the check; over an empty table failures are None.
Measures = Mapping[str, int | None]


@dataclass(frozen=True)
class CheckSpec:
    """One check. Exactly one of ``fails``, ``unique`` and ``reference`` says what a failure is.

    fails      a row for which this condition is true
    unique     a group of rows that share these columns
    reference  (column, parent table): a row whose column value is missing from the parent's column of that name
    """

    table: str
    name: str
    kind: str
    description: str
    fails: Callable[[], Column] | None = None
    unique: Sequence[str] | None = None
    reference: tuple[str, str] | None = None
    layer: str = "silver"

    def __post_init__(self) -> None:
        if sum(rule is not None for rule in (self.fails, self.unique, self.reference)) != 1:
            raise ValueError(f"check {self.name} needs exactly one rule")


def _tag(spec: CheckSpec) -> list[Column]:
    return [
        F.lit(spec.layer).alias("layer_name"),
        F.lit(spec.table).alias("table_name"),
        F.lit(spec.name).alias("check_name"),
        F.lit(spec.kind).alias("check_type"),
        F.lit(spec.description).alias("check_description"),
    ]


def row_measures(specs: Sequence[CheckSpec]) -> list[Column]:
    """The aggregates behind row checks: rows, and failures by name of the check. They can be observed in a write."""
    failures = [F.sum(F.when(s.fails(), 1).otherwise(0)).alias(s.name) for s in specs]
    return [F.count(F.lit(1)).alias("total_records"), *failures]


def _lines(specs: Sequence[CheckSpec]) -> Column:
    lines = [F.struct(*_tag(s), "total_records", F.col(s.name).alias("failed_records")) for s in specs]
    return F.inline(F.array(*lines))


def row_checks(df: DataFrame, specs: Sequence[CheckSpec]) -> DataFrame:
    """All row conditions of one table in one pass; over an empty table the failure count is NULL, not zero."""
    return df.agg(*row_measures(specs)).select(_lines(specs))


def measured_checks(spark: SparkSession, measured: Measures, specs: Sequence[CheckSpec]) -> DataFrame:
    """What ``row_checks`` returns, from numbers that were measured while the table was written; reads no table."""
    numbers = [F.lit(measured[name]).cast("bigint").alias(name) for name in ("total_records", *[s.name for s in specs])]
    return spark.range(1, numPartitions=1).select(*numbers).select(_lines(specs))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of rows, and number of key values (NULL included) that occur more than once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_records"),
        F.count_if(F.col("_rows") > 1).alias("failed_records"),
    )


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: number of child rows, and how many have no parent. A NULL key has no parent.

    Both sides are reduced to one row per key first, so the join never sees a hot key.
    """
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    known = parent.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_known", F.lit(True))
    return per_key.join(known, key, "left").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_rows"))), F.lit(0)).alias("failed_records"),
    )


def run_checks(
    tables: Mapping[str, DataFrame],
    specs: Sequence[CheckSpec],
    executed_at: Column | None = None,
    measured: Mapping[str, Measures] | None = None,
) -> DataFrame:
    """One result row per check: counts, status, percentage, description and execution time.

    The row checks of a table in ``measured`` take the numbers given there and do not read it. They must have been
    measured by ``row_measures`` over the rows that the table holds now. Key and reference checks read their tables.
    """
    branches: list[DataFrame] = []
    by_rows = sorted((s for s in specs if s.fails is not None), key=lambda s: s.table)
    for table, group in groupby(by_rows, key=lambda s: s.table):
        checks = list(group)
        if measured and table in measured:
            branches.append(measured_checks(tables[table].sparkSession, measured[table], checks))
        else:
            branches.append(row_checks(tables[table], checks))
    for spec in specs:
        if spec.unique is not None:
            counted = duplicate_groups(tables[spec.table], spec.unique)
        elif spec.reference is not None:
            key, parent = spec.reference
            counted = orphan_rows(tables[spec.table], tables[parent], key)
        else:
            continue
        branches.append(counted.select(*_tag(spec), "total_records", "failed_records"))
    if not branches:
        raise ValueError("no checks to run")
    if executed_at is None:
        executed_at = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("string")
    results = reduce(DataFrame.unionByName, branches)
    return results.select(
        "layer_name",
        "table_name",
        "check_name",
        "check_type",
        F.when(F.col("failed_records") == 0, "PASS").otherwise("FAIL").alias("status"),
        "total_records",
        "failed_records",
        F.when(F.col("total_records") > 0, pct(F.col("failed_records"), F.col("total_records"), 4))
        .otherwise(0.0)
        .alias("failed_pct"),
        "check_description",
        executed_at.alias("execution_timestamp_utc"),
    )
