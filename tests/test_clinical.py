import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from studymart.contracts import EVENT_SCHEMA, STUDY_SCHEMA
from studymart.operators import clinical
from studymart.operators.marts import (
    calendar_activity,
    dim_time,
    fct_event_rates,
    fct_sleep_summary,
    tile_apnea_trend,
    tile_stage_distribution,
)
from studymart.operators.staging import bronze_to_silver, stg_events, stg_sleep_study


def study(study_id, day=date(2024, 1, 1), minutes=360.0, age="18-30", sex="F", rem=72.0, deep=54.0, light=234.0):
    return (study_id, day, minutes, rem, deep, light, age, sex)


def event(study_id, kind="apnea", when=datetime(2024, 1, 1, 22), seconds=10.0):
    return (study_id, kind, seconds, when)


@pytest.fixture
def facts(frame):
    def build(studies, events):
        summary = fct_sleep_summary(stg_sleep_study(frame(studies, STUDY_SCHEMA)))
        return summary, fct_event_rates(stg_events(frame(events, EVENT_SCHEMA)))

    return build


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_rates_grain_and_null_duration(facts):
    _, rates = facts(
        [],
        [
            event("a", "apnea", datetime(2024, 1, 1, 22), 10.1),
            event("a", "Apnea", datetime(2024, 1, 1, 23), 22.7),
            event("a", None, datetime(2024, 1, 2, 2), None),
        ],
    )
    got = {r.event_date: r for r in rates.collect()}
    first, second = got[date(2024, 1, 1)], got[date(2024, 1, 2)]
    assert (first.total_events, first.apnea_count, first.hypopnea_count, first.arousal_count) == (2, 1, 0, 0)
    assert first.avg_event_duration_sec == pytest.approx(16.4, abs=1e-12)
    assert (second.total_events, second.avg_event_duration_sec) == (1, None)


def test_staging_adds_load_time(frame):
    assert "ingestion_time" in stg_events(frame([event("a")], EVENT_SCHEMA)).columns
    assert stg_sleep_study(frame([study("a")], STUDY_SCHEMA)).columns[-1] == "ingestion_time"
    assert "ingestion_time" not in fct_sleep_summary(stg_sleep_study(frame([study("a")], STUDY_SCHEMA))).columns


def test_silver_keeps_bronze_columns_and_survives_bad_text(frame):
    bronze = frame(
        [("1", "apnea", "12.5", "2024-01-01T22:00:00.000Z"), ("2", "x", "abc", "not a time")],
        "study_id string, event_type string, duration_sec string, study_datetime string",
    )
    silver = bronze_to_silver(bronze).orderBy("study_id")
    assert silver.columns == [
        "study_id", "event_type", "duration_sec", "study_datetime", "event_type_norm", "event_date",
    ]
    good, bad = silver.collect()
    assert (good.duration_sec, good.study_datetime, good.event_date) == (
        12.5, datetime(2024, 1, 1, 22), date(2024, 1, 1),
    )
    assert (bad.event_type_norm, bad.duration_sec, bad.study_datetime, bad.event_date) == ("other", None, None, None)


def test_zero_and_null_minutes(facts):
    summary, rates = facts([study("z", minutes=0.0), study("n", minutes=None)], [event("z")])
    got = {r.study_id: r for r in clinical.clinical_joined(summary, rates).collect()}
    assert got["z"].rem_percentage is None and got["z"].ahi is None and got["z"].ahi_severity == "Severe"
    assert got["n"].ahi is None
    named = clinical.clinical_joined(summary, rates, "Unknown")
    assert {r.ahi_severity for r in named.collect()} == {"Unknown"}


def test_night_over_midnight_fans_out(facts):
    summary, rates = facts(
        [study("a"), study("b")],
        [event("a"), event("a", "hypopnea", datetime(2024, 1, 2, 2)), event("a", "arousal", datetime(2024, 1, 2, 3))],
    )
    joined = clinical.clinical_joined(summary, rates)
    assert joined.where("study_id = 'a'").count() == 2
    quiet = joined.where("study_id = 'b'").first()
    assert (quiet.total_events, quiet.apnea_count, quiet.avg_event_duration_sec, quiet.ahi) == (0, 0, None, 0.0)
    one = clinical.clinical_by_study(summary, rates).where("study_id = 'a'").collect()
    assert len(one) == 1
    assert (one[0].total_events, one[0].ahi) == (3, pytest.approx(2 / 6))


def test_reused_id_matches_dates_of_other_days(facts):
    summary, rates = facts(
        [study("a", date(2024, 1, 1)), study("a", date(2024, 1, 5))],
        [event("a"), event("a", when=datetime(2024, 1, 5, 23))],
    )
    assert clinical.clinical_joined(summary, rates).count() == 4


def random_facts(facts, seed, hot=False):
    rng = random.Random(seed)
    ids = [f"s{i}" for i in range(12)]

    def pick():
        return "s0" if hot and rng.random() < 0.4 else rng.choice(ids)

    studies = [
        study(
            pick(),
            date(2024, 1, rng.randint(1, 28)),
            rng.choice([None, 0.0, 30.0, 60.0, 90.5, 361.0]),
            rng.choice(["18-30", "31-50", None]),
            rng.choice(["M", "F"]),
            rng.choice([None, 10.0, 20.5]),
            rng.choice([None, 15.0, 33.0]),
            rng.choice([None, 100.0, 200.5]),
        )
        for _ in range(120)
    ]
    events = [
        event(
            rng.choice([pick(), "unmatched", None]),
            rng.choice(["apnea", "hypopnea", "arousal", "x", None]),
            datetime(2024, 1, rng.randint(1, 28), rng.randint(0, 23)),
        )
        for _ in range(600)
    ]
    return facts(studies, events)


@pytest.mark.parametrize("seed, hot", [(1, False), (2, True), (3, True)])
def test_folded_figures_equal_those_of_the_joined_rows(facts, seed, hot):
    summary, rates = random_facts(facts, seed, hot)
    joined = clinical.clinical_joined(summary, rates).toPandas()
    cells = clinical.cohort_cells(summary, rates)
    units = clinical.unit_cells(clinical.clinical_joined(summary, rates))
    for frame_of_cells in (cells, units):
        overview = clinical.cohort_overview(frame_of_cells).first()
        assert overview.total_studies == len(joined)
        assert overview.avg_ahi == pytest.approx(joined.ahi.mean())
        assert overview.severe_pct == pytest.approx((joined.ahi_severity == "Severe").mean() * 100)
        assert overview.avg_sleep_hours == pytest.approx(joined.total_sleep_time_min.mean() / 60)
        shares = dict(rows(clinical.sleep_architecture(frame_of_cells)))
        minutes = joined.total_sleep_time_min.mean()
        assert shares["REM"] == pytest.approx(joined.rem_percentage.mean())
        assert shares["Deep"] == pytest.approx(joined.deep_min.mean() / minutes * 100)
        assert shares["Light"] == pytest.approx(joined.light_min.mean() / minutes * 100)
        assert dict(rows(clinical.severity_distribution(frame_of_cells))) == dict(joined.ahi_severity.value_counts())
        by_age = dict(rows(clinical.ahi_by_age(frame_of_cells)))
        expected = joined.groupby("age_group").ahi.mean()
        assert None not in by_age and by_age == {k: pytest.approx(v) for k, v in expected.items()}


def test_folding_bounds_the_rows_of_a_hot_id(facts):
    """Joined rows grow with the product of an id's rows, cells with its distinct values only."""
    days = range(1, 29)
    studies = [study("hot", date(2024, 1, d), 60.0) for d in days for _ in range(20)]
    events = [event("hot", when=datetime(2024, 1, d, 22)) for d in days]
    summary, rates = facts(studies, events)
    cells = clinical.cohort_cells(summary, rates)
    assert cells.count() == 1
    assert cells.first().weight == 28 * 20 * 28


def test_empty_cohort(facts):
    summary, rates = facts([study("a")], [event("a")])
    nobody = clinical.cohort_filter(summary, sexes=["X"])
    cells = clinical.cohort_cells(nobody, rates)
    assert rows(clinical.cohort_overview(cells)) == [(0, None, 0.0, None)]
    assert rows(clinical.sleep_architecture(cells)) == []
    assert rows(clinical.severity_distribution(cells)) == []


def test_no_architecture_without_sleep(facts):
    summary, rates = facts([study("a", minutes=0.0)], [])
    assert rows(clinical.sleep_architecture(clinical.cohort_cells(summary, rates))) == []


def test_cohort_filter(frame):
    df = frame(
        [study("a", date(2024, 1, 1), sex="M"), study("b", date(2024, 1, 2)), study("c", date(2024, 1, 3), age="71+")],
        STUDY_SCHEMA,
    )

    def ids(**conditions):
        return sorted(r.study_id for r in clinical.cohort_filter(df, **conditions).collect())

    assert ids() == ["a", "b", "c"]
    assert ids(start=date(2024, 1, 1), end="2024-01-02") == ["a", "b"]
    assert ids(start=date(2024, 1, 3)) == ["a", "b", "c"]  # an incomplete range is no filter
    assert ids(sexes=["F"], age_groups=["71+"]) == ["c"]
    assert ids(sexes=[]) == []


@pytest.mark.parametrize("seed", [4, 5])
def test_patient_takes_the_first_row(facts, seed):
    summary, rates = random_facts(facts, seed, hot=True)
    joined = (
        summary.join(rates.select("study_id", "event_date", "apnea_count", "hypopnea_count"), "study_id", "left")
        .toPandas()
        .sort_values(
            ["study_date", "total_sleep_time_min", "rem_percentage", "deep_min", "event_date"], na_position="first"
        )
    )
    first = joined.groupby("study_id").head(1).set_index("study_id")
    for row in clinical.first_joined_rows(summary, rates).collect():
        assert row.study_date == first.loc[row.study_id].study_date
        expected = first.loc[row.study_id].apnea_count
        assert row.apnea_count == (0 if expected != expected else expected)


def test_patient_vs_cohort(facts):
    summary, rates = facts([study("a", minutes=60.0, rem=12.0, deep=20.0), study("b", minutes=120.0, rem=12.0, deep=40.0)], [event("a")])
    got = {r.metric: (r.patient, r.cohort_avg) for r in clinical.patient_vs_cohort(summary, rates, "a").collect()}
    assert got == {"AHI": (1.0, 0.5), "REM %": (20.0, 15.0), "Deep Sleep (min)": (20.0, 30.0)}
    every = clinical.patient_scorecards(summary, rates)
    assert every.count() == 6
    assert rows(clinical.patient_vs_cohort(summary, rates, "a' OR '1'='1")) == []


def test_dataset_stats_and_values(facts):
    summary, _ = facts([study("a"), study("a", date(2024, 3, 1)), study("b", sex="M")], [])
    assert rows(clinical.dataset_stats(summary)) == [(2, date(2024, 1, 1), date(2024, 3, 1))]
    assert sorted(rows(clinical.distinct_values(summary, ["sex", "study_id"]))) == [
        ("sex", "F"), ("sex", "M"), ("study_id", "a"), ("study_id", "b"),
    ]


def test_calendar(spark, facts):
    calendar = dim_time(spark)
    got = calendar.agg(F.count("*"), F.min("date_actual"), F.max("date_actual"), F.countDistinct("date_actual")).first()
    assert tuple(got) == (3660, date(2020, 1, 1), date(2030, 1, 7), 3660)
    assert rows(calendar.where("date_actual = '2024-11-30'")) == [(date(2024, 11, 30), 2024, 11, 4)]
    _, rates = facts([], [event("a"), event("b")])
    busy = calendar_activity(calendar, rates)
    assert busy.count() == 3660
    assert rows(busy.where("total_events > 0")) == [(date(2024, 1, 1), 2024, 1, 1, 2)]


def test_tiles(facts):
    summary, rates = facts(
        [study("a", rem=10.0), study("b", rem=20.0)],
        [event("a"), event("a", "hypopnea"), event("b", "arousal"), event("a", when=datetime(2024, 2, 1, 1))],
    )
    assert rows(tile_apnea_trend(rates)) == [(date(2024, 1, 1), 1.0), (date(2024, 2, 1), 1.0)]
    assert rows(tile_stage_distribution(summary)) == [("18-30", 15.0, 54.0, 234.0)]
