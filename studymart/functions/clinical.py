"""Scalar column expressions. All are built-in expressions, so they stay in codegen."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studymart.contracts import (
    AHI_CLASSES,
    AHI_TOP_CLASS,
    KEPT_EVENT_TYPES,
    NULL_TOKENS,
    OTHER_EVENT_TYPE,
    STAGE_ORDER,
)


def normalise_event_type(
    event_type: Column,
    keep: Iterable[str] = KEPT_EVENT_TYPES,
    other: str = OTHER_EVENT_TYPE,
) -> Column:
    """Known types as they are; anything else, NULL and other spellings included, is ``other``."""
    return F.when(event_type.isin(*keep), event_type).otherwise(other)


def null_if_token(text: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """NULL where the text is one of the file format's null markers."""
    return F.when(~text.isin(*tokens), text)


def try_read(value: Column, data_type: T.DataType) -> Column:
    """The value as the type, NULL where it doesn't read.

    A time with an offset is moved to UTC, a time without one is kept; the session zone is UTC.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return value.try_cast(T.TimestampType()).cast(data_type)
    return value.try_cast(data_type)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; NULL where ``whole`` is 0, also in ANSI mode."""
    return part / F.nullif(whole, F.lit(0))


def percentage(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def ahi(apnea: Column, hypopnea: Column, sleep_min: Column) -> Column:
    """Apnea-hypopnea index: breathing events per hour of sleep, NULL without sleep."""
    return ratio(apnea + hypopnea, sleep_min / 60)


def ahi_severity(index: Column, unknown_label: str = AHI_TOP_CLASS) -> Column:
    """Severity class of an index. NULL and NaN take ``unknown_label``."""
    classes = F.when(index.isNull() | F.isnan(index), unknown_label)
    for bound, label in AHI_CLASSES:
        classes = classes.when(index < bound, label)
    return classes.otherwise(AHI_TOP_CLASS)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def band_label(column_name: Column) -> Column:
    """``avg_delta_rel`` -> ``delta``."""
    return F.regexp_replace(column_name, "(?i)avg_|_rel", "")


def stage_rank(stage: Column) -> Column:
    """Position of a stage on the hypnogram axis, from 1; NULL for an unknown label."""
    order = F.array(*[F.lit(s) for s in STAGE_ORDER])
    return F.nullif(F.array_position(order, stage), F.lit(0)).cast("int")
