"""The clinical join and the cohort figures derived from it.

Grain. Event rates have one row per study and date, so joining them to the studies on
``study_id`` gives one row per (study row, event date): a night over midnight counts twice,
and studies of different days that share an id match each other's dates. `clinical_joined`
is exactly that frame. `clinical_by_study` sums the rates per study first and is the one to
use for a per-study index.

Cohort figures are means and counts over `clinical_joined`. They never build its pairs:
`cohort_cells` folds both sides per study id first and carries a weight, which says how
many joined rows a cell stands for.
"""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from studymart.contracts import AHI_TOP_CLASS
from studymart.functions import ahi, ahi_severity, ratio, zero_if_null
from studymart.operators.skew import split_left_join

COUNTS = ("total_events", "apnea_count", "hypopnea_count", "arousal_count")
SUMMARY_COLUMNS = (
    "study_id",
    "study_date",
    "total_sleep_time_min",
    "rem_percentage",
    "deep_min",
    "light_min",
    "age_group",
    "sex",
)
# Study measures whose cohort means are taken, with the prefix of their sum and row count.
MEASURES = {"rem_percentage": "rem", "deep_min": "deep", "light_min": "light"}


def _with_index(df: DataFrame, unknown_label: str) -> DataFrame:
    index = ahi(F.col("apnea_count"), F.col("hypopnea_count"), F.col("total_sleep_time_min"))
    return df.withColumn("ahi", index).withColumn(
        "ahi_severity", ahi_severity(F.col("ahi"), unknown_label)
    )


def clinical_joined(
    summary: DataFrame,
    rates: DataFrame,
    unknown_label: str = AHI_TOP_CLASS,
    unique_ids: bool = False,
) -> DataFrame:
    """Studies with their event rates by date; studies without events keep zero counts.

    Every study id is joined in as many parts as its rows and dates, multiplied, ask for, so an
    id that repeats ends in no single task. ``summary`` should be a row-wise view of a table;
    filter it before. With ``unique_ids`` the caller vouches for one row per id, as tested marts
    have, and the join is a plain one.
    """
    studies = summary.select(*SUMMARY_COLUMNS)
    if unique_ids:
        joined = studies.join(rates, "study_id", "left")
    else:
        joined = split_left_join(studies, rates, "study_id", F.monotonically_increasing_id(), F.xxhash64("event_date"))
    return _with_index(
        joined.select(
            *SUMMARY_COLUMNS,
            *[zero_if_null(F.col(c)).alias(c) for c in COUNTS],
            "avg_event_duration_sec",
        ),
        unknown_label,
    )


def clinical_by_study(
    summary: DataFrame, rates: DataFrame, unknown_label: str = AHI_TOP_CLASS
) -> DataFrame:
    """One row per study row: counts of all dates summed before the join."""
    totals = rates.groupBy("study_id").agg(*[F.sum(c).alias(c) for c in COUNTS])
    joined = summary.select(*SUMMARY_COLUMNS).join(totals, "study_id", "left")
    return _with_index(
        joined.select(*SUMMARY_COLUMNS, *[zero_if_null(F.col(c)).alias(c) for c in COUNTS]),
        unknown_label,
    )


def cohort_filter(
    df: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    sexes: Sequence[str] | None = None,
    age_groups: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of a cohort. The date range is inclusive and applies only when both ends are given.

    Works on studies and on joined frames alike; all columns belong to the study side, so
    on a joined frame the conditions move below the join.
    """
    if start is not None and end is not None:
        first, last = (F.to_date(F.lit(str(d))) for d in (start, end))
        df = df.where(F.col("study_date").between(first, last))
    if sexes is not None:
        df = df.where(F.col("sex").isin(*sexes))
    if age_groups is not None:
        df = df.where(F.col("age_group").isin(*age_groups))
    return df


def _measure_columns(weight: Column, value) -> list[Column]:
    """Sum and row count of every measure, each cell row standing for ``weight`` rows."""
    columns = []
    for measure, prefix in MEASURES.items():
        total, rows = value(measure, prefix)
        columns += [(total * weight).alias(f"{prefix}_sum"), (rows * weight).alias(f"{prefix}_rows")]
    return columns


def cohort_cells(
    summary: DataFrame, rates: DataFrame, unknown_label: str = AHI_TOP_CLASS
) -> DataFrame:
    """`clinical_joined` in folded form: one row per study id, sleep time, age group and
    number of breathing events, with the count of joined rows it stands for.

    Both sides are folded before they meet, so repeated ids never multiply raw rows. A
    cell is bounded by the distinct sleep times of an id on one side and its distinct
    daily sums on the other, and an id with many of both is joined in parts. Apply `cohort_filter` to ``summary`` first.
    """
    studies = summary.groupBy("study_id", "total_sleep_time_min", "age_group").agg(
        F.count("*").alias("study_rows"),
        *[F.sum(m).alias(f"{p}_total") for m, p in MEASURES.items()],
        *[F.count(m).alias(f"{p}_count") for m, p in MEASURES.items()],
    )
    # The index needs the breathing events of a day, not which they were.
    breathing = (F.col("apnea_count") + F.col("hypopnea_count")).alias("breathing")
    daily = rates.groupBy("study_id", breathing).agg(F.count("*").alias("days"))
    days = F.coalesce("days", F.lit(1))
    salt = F.xxhash64("total_sleep_time_min", "age_group")
    cells = split_left_join(studies, daily, "study_id", salt, F.col("breathing")).select(
        "study_id",
        "total_sleep_time_min",
        "age_group",
        zero_if_null(F.col("breathing")).alias("apnea_count"),
        F.lit(0).alias("hypopnea_count"),
        (F.col("study_rows") * days).alias("weight"),
        *_measure_columns(days, lambda m, p: (F.col(f"{p}_total"), F.col(f"{p}_count"))),
    )
    return _with_index(cells, unknown_label).drop("apnea_count", "hypopnea_count")


def unit_cells(clinical: DataFrame) -> DataFrame:
    """A joined frame in the shape of `cohort_cells`, every row standing for itself."""
    one = F.lit(1)
    return clinical.select(
        "study_id",
        "total_sleep_time_min",
        "age_group",
        "ahi",
        "ahi_severity",
        one.cast("long").alias("weight"),
        *_measure_columns(
            one, lambda m, p: (F.col(m), F.col(m).isNotNull().cast("long"))
        ),
    )


def _weighted_mean(value: str) -> Column:
    """Mean of a column over the rows the cells stand for; NULLs are left out."""
    weight = F.when(F.col(value).isNotNull(), F.col("weight"))
    return F.sum(F.col(value) * F.col("weight")) / F.nullif(F.sum(weight), F.lit(0))


def _measure_mean(prefix: str) -> Column:
    return F.sum(f"{prefix}_sum") / F.nullif(F.sum(f"{prefix}_rows"), F.lit(0))


def cohort_overview(cells: DataFrame) -> DataFrame:
    """Row count, mean index, share of the top class in percent, mean hours of sleep."""
    severe = F.sum(F.when(F.col("ahi_severity") == AHI_TOP_CLASS, F.col("weight")).otherwise(0))
    total = zero_if_null(F.sum("weight"))
    return cells.agg(
        total.alias("total_studies"),
        _weighted_mean("ahi").alias("avg_ahi"),
        zero_if_null(100.0 * severe / F.nullif(total, F.lit(0))).alias("severe_pct"),
        (_weighted_mean("total_sleep_time_min") / 60).alias("avg_sleep_hours"),
    )


def sleep_architecture(cells: DataFrame) -> DataFrame:
    """Stage mix in percent: mean of ratios for REM, ratio of means for deep and light.

    Empty when the mean sleep time is not positive.
    """
    means = cells.agg(
        _measure_mean("rem").alias("rem_pct"),
        _measure_mean("deep").alias("deep_min"),
        _measure_mean("light").alias("light_min"),
        _weighted_mean("total_sleep_time_min").alias("total_min"),
    ).where(F.col("total_min") > 0)
    shares = means.select(
        F.col("rem_pct").alias("REM"),
        (F.col("deep_min") / F.col("total_min") * 100).alias("Deep"),
        (F.col("light_min") / F.col("total_min") * 100).alias("Light"),
    )
    return shares.unpivot([], ["REM", "Deep", "Light"], "stage", "percentage")


def severity_distribution(cells: DataFrame) -> DataFrame:
    """Rows per severity class, largest first."""
    return (
        cells.groupBy("ahi_severity")
        .agg(F.sum("weight").alias("studies"))
        .orderBy(F.desc("studies"), "ahi_severity")
    )


def ahi_by_age(cells: DataFrame) -> DataFrame:
    """Mean index per age group; studies without an age group belong to none."""
    known = cells.where(F.col("age_group").isNotNull())
    return known.groupBy("age_group").agg(_weighted_mean("ahi").alias("avg_ahi"))


def ahi_vs_duration(clinical: DataFrame) -> DataFrame:
    """Scatter columns: sleep time, index, age group and arousals of every joined row."""
    return clinical.select("total_sleep_time_min", "ahi", "age_group", "arousal_count")


def dataset_stats(summary: DataFrame) -> DataFrame:
    """Distinct studies and the date range.

    A left join neither adds nor removes study values, so the studies alone give the figures
    of the joined frame.
    """
    return summary.agg(
        F.countDistinct("study_id").alias("unique_patients"),
        F.min("study_date").alias("start_date"),
        F.max("study_date").alias("end_date"),
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several text columns as (dimension, value), in one scan."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs)).distinct()


def _scorecard(df: DataFrame, cohort: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(metric, patient, cohort_avg) rows. The cohort row comes in as a scalar subquery."""
    averages = cohort.agg(
        F.struct(
            _weighted_mean("ahi").alias("ahi"),
            _measure_mean("rem").alias("rem"),
            _measure_mean("deep").alias("deep"),
        ).alias("averages")
    )
    lines = [
        ("AHI", "ahi", "ahi"),
        ("REM %", "rem_percentage", "rem"),
        ("Deep Sleep (min)", "deep_min", "deep"),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                F.col(patient).alias("patient"),
                F.col(f"averages.{average}").alias("cohort_avg"),
            )
            for metric, patient, average in lines
        ]
    )
    return df.withColumn("averages", averages.scalar()).select(*keys, F.inline(rows))


def first_joined_rows(summary: DataFrame, rates: DataFrame) -> DataFrame:
    """The first joined row of every study id: earliest study date, then earliest event date.

    Ties between studies of one date go to the smallest values. Each side is reduced with
    ``min`` over a struct, which folds inside every task, so a large id needs no sort.
    """
    order = ("study_date", "total_sleep_time_min", "rem_percentage", "deep_min")
    studies = summary.groupBy("study_id").agg(F.min(F.struct(*order)).alias("study"))
    days = rates.groupBy("study_id").agg(F.min(F.struct("event_date", *COUNTS)).alias("day"))
    first = studies.join(days, "study_id", "left").select(
        "study_id", "study.*", *[zero_if_null(F.col(f"day.{c}")).alias(c) for c in COUNTS]
    )
    return _with_index(first, AHI_TOP_CLASS)


def patient_vs_cohort(summary: DataFrame, rates: DataFrame, study_id: str) -> DataFrame:
    """One patient's index, REM share and deep minutes beside the cohort means."""
    this = F.col("study_id") == F.lit(study_id)
    patient = first_joined_rows(summary.where(this), rates.where(this))
    return _scorecard(patient, cohort_cells(summary, rates), [])


def patient_scorecards(summary: DataFrame, rates: DataFrame) -> DataFrame:
    """`patient_vs_cohort` for every patient at once."""
    return _scorecard(first_joined_rows(summary, rates), cohort_cells(summary, rates), ["study_id"])


def patient_details(summary: DataFrame, rates: DataFrame) -> DataFrame:
    """The drill-down figures of every patient's first joined row; filter by study id for one."""
    return first_joined_rows(summary, rates).select(
        "study_id",
        "ahi",
        "ahi_severity",
        "total_events",
        "arousal_count",
        ratio(F.col("total_sleep_time_min"), F.lit(60)).alias("sleep_hours"),
    )


def display(df: DataFrame, decimals: int = 1) -> DataFrame:
    """The frame with its doubles rounded, as figures are shown."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({name: F.round(name, decimals) for name in doubles})
