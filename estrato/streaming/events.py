"""Decode, validate and coerce JSON events with native expressions.

The payload is parsed once into a VARIANT, which keeps each field's own JSON type, so text and numbers can be
coerced by different rules.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event fields with their types; the first six are required.
REQUIRED = {
    "ano": "int",
    "sigla_uf": "string",
    "serie": "int",
    "rede": "int",
    "taxa_alfabetizacao": "double",
    "media_portugues": "double",
}
OPTIONAL = {
    "proporcao_aluno_nivel_0": "int",
    "proporcao_aluno_nivel_1": "double",
    "proporcao_aluno_nivel_2": "double",
    "proporcao_aluno_nivel_3": "double",
    "proporcao_aluno_nivel_4": "double",
    "proporcao_aluno_nivel_5": "double",
    "proporcao_aluno_nivel_6": "double",
    "proporcao_aluno_nivel_7": "double",
    "proporcao_aluno_nivel_8": "double",
}
FIELDS = {**REQUIRED, **OPTIONAL}

NOT_DECODED = "decode"
MISSING_FIELD = "required"
NOT_COERCIBLE = "coercion"

REASON = "reject_reason"


def decode(value: Column) -> Column:
    """The payload as VARIANT; NULL for a NULL payload and for anything that is not UTF-8 JSON."""
    return F.try_parse_json(value.cast("string"))


def _fields(payload: Column, kinds: dict[str, str]) -> Column:
    """All known fields of an object payload in one walk, as a struct; NULL where a field does not fit its kind."""
    shape = ", ".join(f"{name}: {kind}" for name, kind in kinds.items())
    return F.try_variant_get(payload, "$", f"struct<{shape}>")


def typed_fields(payload: Column) -> Column:
    """The fields coerced to their types: numbers are truncated to integers, text must spell the whole value."""
    return _fields(payload, FIELDS)


def given_fields(payload: Column) -> Column:
    """The fields as text. Any JSON value but null has a text, so non-NULL means the field was given."""
    return _fields(payload, dict.fromkeys(FIELDS, "string"))


def has_required(given: Column) -> Column:
    """Whether all required fields are given; false for a payload that is not an object."""
    return reduce(and_, [given[name].isNotNull() for name in REQUIRED])


def parse_events(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the typed fields and ``reject_reason`` (NULL for an accepted event) to a frame of raw events.

    A field that is given but cannot be coerced rejects the event.
    """
    kept = [c for c in df.columns if c not in FIELDS]
    decoded = df.withColumn("_payload", decode(F.col(value)))
    payload = F.col("_payload")
    parts = F.struct(
        payload.isNotNull().alias("_decoded"),
        given_fields(payload).alias("_given"),
        typed_fields(payload).alias("_typed"),
    )
    # A one-element inline: a later filter on the result cannot be pushed below it and parse every event twice.
    walked = decoded.select(*kept, F.inline(F.array(parts)))
    given, typed = F.col("_given"), F.col("_typed")
    failed = reduce(or_, [given[name].isNotNull() & typed[name].isNull() for name in FIELDS])
    reason = (
        F.when(~F.col("_decoded"), NOT_DECODED)
        .when(~has_required(given), MISSING_FIELD)
        .when(failed, NOT_COERCIBLE)
    )
    return walked.select(*kept, *[typed[name].alias(name) for name in FIELDS], reason.alias(REASON))


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted events without the reason column, and rejected ones with it but without the typed fields."""
    accepted = parsed.filter(F.col(REASON).isNull()).drop(REASON)
    rejected = parsed.filter(F.col(REASON).isNotNull()).drop(*FIELDS)
    return accepted, rejected
