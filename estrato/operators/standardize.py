"""Bring raw columns to their declared types and names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.functions.casts import Cast, apply_cast


def standardize(df: DataFrame, casts: Sequence[Cast], passthrough: Sequence[str] = ()) -> DataFrame:
    """One projection: the cast columns in order, then ``passthrough`` untouched. Everything else is pruned."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[apply_cast(c, types[c.source]) for c in casts], *[F.col(n) for n in passthrough])
