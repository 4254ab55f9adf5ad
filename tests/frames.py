"""Small frames for tests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from estrato.plans.silver import SilverSpec
from estrato.sources.lineage import LINEAGE


def lineage(ts: str = "2024-01-01T08:00:00-03:00", run: str = "20240101T080000Z", table: str = "t") -> dict[str, str]:
    values = ("base_dos_dados", table, "dataset", table, ts, ts[:10], run)
    return dict(zip(LINEAGE, values))


def bronze(spark: SparkSession, spec: SilverSpec, rows: Iterable[dict]) -> DataFrame:
    """A bronze table of text columns; absent columns are NULL."""
    names = [c.source for c in spec.casts] + list(LINEAGE)
    schema = ", ".join(f"{n} string" for n in names)
    data = []
    for row in rows:
        full = {**lineage(), **row}
        data.append(tuple(None if full.get(n) is None else str(full[n]) for n in names))
    return spark.createDataFrame(data, schema)


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
