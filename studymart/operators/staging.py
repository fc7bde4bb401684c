"""Raw tables -> cleaned rows. Row-wise projections only: no shuffle anywhere here."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studymart.contracts import EVENT_SCHEMA, KEPT_EVENT_TYPES, STUDY_SCHEMA
from studymart.functions import normalise_event_type, try_read


def stg_events(raw_events: DataFrame, keep: Iterable[str] = KEPT_EVENT_TYPES) -> DataFrame:
    """Events with the type normalised in place, the calendar date and a load time."""
    return raw_events.select(
        "study_id",
        "duration_sec",
        "study_datetime",
        normalise_event_type(F.col("event_type"), keep).alias("event_type"),
        F.to_date("study_datetime").alias("event_date"),
        F.current_timestamp().alias("ingestion_time"),
    )


def stg_sleep_study(raw_studies: DataFrame) -> DataFrame:
    """The study columns and a load time."""
    return raw_studies.select(*STUDY_SCHEMA.names, F.current_timestamp().alias("ingestion_time"))


def bronze_to_silver(bronze: DataFrame, keep: Iterable[str] = KEPT_EVENT_TYPES) -> DataFrame:
    """Landed events, typed, keeping every bronze column and adding type and date.

    The raw ``event_type`` stays beside ``event_type_norm``. A value that cannot be typed
    becomes NULL; `studymart.operators.quality.contract_rules` counts those.
    """
    types = {f.name: f.dataType for f in EVENT_SCHEMA.fields}
    return bronze.withColumns(
        {
            "event_type_norm": normalise_event_type(F.col("event_type"), keep),
            "duration_sec": try_read(F.col("duration_sec"), types["duration_sec"]),
            "study_datetime": try_read(F.col("study_datetime"), types["study_datetime"]),
        }
    ).withColumn("event_date", F.to_date("study_datetime"))
