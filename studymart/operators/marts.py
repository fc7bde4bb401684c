"""Fact and dimension tables, and the saved chart queries over them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studymart.contracts import CALENDAR_DAYS, CALENDAR_START, KEPT_EVENT_TYPES, STUDY_SCHEMA
from studymart.functions import month_start, percentage


def event_counts(event_type: Column) -> list[Column]:
    return [
        F.count("*").alias("total_events"),
        *[F.count_if(event_type == kind).alias(f"{kind}_count") for kind in KEPT_EVENT_TYPES],
    ]


def fct_event_rates(
    events: DataFrame,
    type_column: str = "event_type",
    keys: Sequence[str] = ("study_id", "event_date"),
) -> DataFrame:
    """Event counts and mean duration per study and date.

    Every measure is a count or a mean, so each task folds its own rows first and the one
    shuffle moves a row per (task, group): a study holding a third of all events costs
    no more than another.
    """
    return events.groupBy(*keys).agg(
        *event_counts(F.col(type_column)),
        F.avg("duration_sec").alias("avg_event_duration_sec"),
    )


def rate_states(events: DataFrame, type_column: str, keys: Sequence[str]) -> DataFrame:
    """What events add to their rates: counts, the sum of durations and how many there are.

    States of parts of the events merge by `rates_of_states` into the rates of all.
    """
    return events.groupBy(*keys).agg(
        *event_counts(F.col(type_column)),
        F.sum("duration_sec").alias("duration_sum"),
        F.count("duration_sec").alias("durations"),
    )


def rates_of_states(states: DataFrame, keys: Sequence[str] = ("study_id", "event_date")) -> DataFrame:
    """`fct_event_rates` from the states of its parts."""
    counts = ["total_events", *[f"{kind}_count" for kind in KEPT_EVENT_TYPES]]
    mean = F.sum("duration_sum") / F.nullif(F.sum("durations"), F.lit(0).cast("long"))
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts], mean.alias("avg_event_duration_sec"))


def fct_sleep_summary(studies: DataFrame) -> DataFrame:
    """Studies with the REM share in percent; NULL for a night without sleep."""
    return studies.select(
        *STUDY_SCHEMA.names,
        percentage(F.col("rem_min"), F.col("total_sleep_time_min")).alias("rem_percentage"),
    )


def dim_time(
    spark: SparkSession, start: str = CALENDAR_START, days: int = CALENDAR_DAYS
) -> DataFrame:
    """Gap-free calendar: date, year, month, quarter."""
    day = F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int"))
    return (
        spark.range(0, days, 1, 1)
        .select(day.alias("date_actual"))
        .select(
            "date_actual",
            F.year("date_actual").alias("year"),
            F.month("date_actual").alias("month"),
            F.quarter("date_actual").alias("quarter"),
        )
    )


def calendar_activity(calendar: DataFrame, rates: DataFrame) -> DataFrame:
    """Every calendar day with the events that fell on it, 0 where there were none.

    Days outside the calendar that have events get a line too, and so do undated events.
    """
    per_day = rates.groupBy("event_date").agg(F.sum("total_events").alias("day_events"))
    both = calendar.join(per_day, calendar.date_actual == per_day.event_date, "full")
    day = F.coalesce("date_actual", "event_date")
    return both.select(
        day.alias("date_actual"),
        *[part(day).cast("int").alias(n) for n, part in (("year", F.year), ("month", F.month), ("quarter", F.quarter))],
        F.coalesce("day_events", F.lit(0)).alias("total_events"),
    )


def tile_apnea_trend(rates: DataFrame) -> DataFrame:
    """Mean of the daily apnea + hypopnea counts by month, in month order.

    The column is called avg_ahi although it is not per hour of sleep.
    """
    return (
        rates.groupBy(month_start(F.col("event_date")).alias("month"))
        .agg(F.avg(F.col("apnea_count") + F.col("hypopnea_count")).alias("avg_ahi"))
        .orderBy("month")
    )


def tile_stage_distribution(summary: DataFrame) -> DataFrame:
    """Mean minutes per sleep stage by age group."""
    return summary.groupBy("age_group").agg(
        F.avg("rem_min").alias("avg_rem"),
        F.avg("deep_min").alias("avg_deep"),
        F.avg("light_min").alias("avg_light"),
    )
