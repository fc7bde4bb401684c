"""Schemas, value domains and thresholds shared by every module."""

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Values that decide results; they are stated once, here.

KEPT_EVENT_TYPES = ("apnea", "hypopnea", "arousal")
OTHER_EVENT_TYPE = "other"
EVENT_TYPES = KEPT_EVENT_TYPES + (OTHER_EVENT_TYPE,)

# (upper bound, label): an index below the bound takes the label.
AHI_CLASSES = ((5, "Normal"), (15, "Mild"), (30, "Moderate"))
AHI_TOP_CLASS = "Severe"

STAGE_ORDER = (
    "Sleep stage W",
    "Sleep stage R",
    "Sleep stage 1",
    "Sleep stage 2",
    "Sleep stage 3",
    "Sleep stage 4",
)

# Half-open frequency bands in Hz; None = up to the Nyquist frequency.
BANDS = (
    ("delta", 0.5, 4.0),
    ("theta", 4.0, 8.0),
    ("alpha", 8.0, 12.0),
    ("beta", 12.0, 30.0),
    ("gamma", 30.0, None),
)

NULL_TOKENS = ("NULL", "null", "")

STAGE_SUM_BUFFER_MIN = 1

CALENDAR_START = "2020-01-01"
CALENDAR_DAYS = 3660

# --- Columns and schemas ----------------------------------------------------

REJECTS = "rejected_fields"  # columns of a typed row that were unreadable
DAY = "dt"  # partition column of every landed, silver and gold folder

STUDY_SCHEMA = T.StructType(
    [
        T.StructField("study_id", T.StringType()),
        T.StructField("study_date", T.DateType()),
        T.StructField("total_sleep_time_min", T.DoubleType()),
        T.StructField("rem_min", T.DoubleType()),
        T.StructField("deep_min", T.DoubleType()),
        T.StructField("light_min", T.DoubleType()),
        T.StructField("age_group", T.StringType()),
        T.StructField("sex", T.StringType()),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("study_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("study_datetime", T.TimestampNTZType()),
    ]
)

EVENT_SILVER_SCHEMA = T.StructType(
    [
        T.StructField("study_id", T.StringType()),
        T.StructField("event_type_norm", T.StringType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("study_datetime", T.TimestampNTZType()),
        T.StructField("event_date", T.DateType()),
    ]
)

EPOCH_SCHEMA = T.StructType(
    [
        T.StructField("subject_id", T.StringType()),
        T.StructField("epoch_id", T.LongType()),
        T.StructField("sleep_stage", T.StringType()),
        T.StructField("samples", T.ArrayType(T.DoubleType())),
    ]
)

# Columns a landed record must carry.
REQUIRED_STUDY_COLUMNS = ("study_id", "study_date")
REQUIRED_EVENT_COLUMNS = ("study_id", "event_type")

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("rule", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("violations", T.LongType(), False),
    ]
)


def landing_columns(schema: T.StructType) -> list[str]:
    """Column order of a landed CSV file: alphabetical."""
    return sorted(schema.names)


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all strings, as they stand in a CSV file."""
    return T.StructType([T.StructField(n, T.StringType()) for n in schema.names])


def with_decimals(schema: T.StructType, precision: int = 10, scale: int = 2) -> T.StructType:
    """The same columns with fixed-point numbers in place of doubles."""
    fixed = T.DecimalType(precision, scale)
    return T.StructType(
        [
            T.StructField(f.name, fixed if isinstance(f.dataType, T.DoubleType) else f.dataType)
            for f in schema.fields
        ]
    )
