"""Safe casts and text normalisation. A value that cannot be cast becomes NULL, never an error."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = " \t\n\r\x0b\x0c"

INT = "int"
DOUBLE = "double"
TEXT = "text"
TRIMMED = "trimmed"
UPPER_TRIMMED = "upper_trimmed"


@dataclass(frozen=True)
class Cast:
    """Read column ``source``, bring it to ``kind``, call it ``target``."""

    source: str
    kind: str
    target: str | None = None

    @property
    def name(self) -> str:
        return self.target or self.source


def safe_int(column: Column, source_type: T.DataType) -> Column:
    """Integer or NULL. Fractions in numeric columns round half up; fractions in text are not integers."""
    if isinstance(source_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        column = F.round(column)
    return column.try_cast("int")


def trimmed(column: Column) -> Column:
    return F.btrim(column.cast("string"), F.lit(WHITESPACE))


def apply_cast(cast: Cast, source_type: T.DataType) -> Column:
    column = F.col(cast.source)
    if cast.kind == INT:
        column = safe_int(column, source_type)
    elif cast.kind == DOUBLE:
        column = column.try_cast("double")
    elif cast.kind == TEXT:
        if isinstance(source_type, T.StringType) and cast.name == cast.source:
            return column  # as it is, without a name that only some readers of a shared shuffle would see removed
        column = column.cast("string")
    elif cast.kind == TRIMMED:
        column = trimmed(column)
    elif cast.kind == UPPER_TRIMMED:
        column = F.upper(trimmed(column))
    else:
        raise ValueError(f"unknown cast {cast.kind!r} for column {cast.source}")
    return column.alias(cast.name)
