from datetime import date, datetime
from pathlib import Path

import pytest

from studymart.__main__ import main
from studymart.contracts import EVENT_SCHEMA, STUDY_SCHEMA
from studymart.operators.quality import QualityGateError
from studymart.operators import signals
from studymart.plans import features, models
from studymart.sources import tables

STUDY_LINES = (
    "age_group,deep_min,light_min,rem_min,sex,study_date,study_id,total_sleep_time_min\n"
    "18-30,50.0,200.0,50.0,F,2024-01-01,a,300.0\n"
    "71+,40.0,200.0,60.0,M,2024-01-01,b,300.0\n"
)
EVENT_LINES = (
    "duration_sec,event_type,study_datetime,study_id\n"
    "10.5,apnea,2024-01-01T22:00:00.000Z,a\n"
    "NULL,Apnea,2024-01-01T23:00:00.000Z,a\n"
)


@pytest.fixture
def databases(spark, base):
    Path(base, "studies.csv").write_text(STUDY_LINES)
    Path(base, "events.csv").write_text(EVENT_LINES)
    yield "raw_test", "mart_test"
    for name in ("raw_test", "mart_test"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def load(spark, base, raw):
    tables.create_raw_tables(spark, raw, ingestion_time=True)
    tables.load_csv(spark, f"{base}/studies.csv", f"{raw}.sleep_studies", STUDY_SCHEMA)
    tables.load_csv(spark, base, f"{raw}.events", EVENT_SCHEMA, file_pattern=".*events.*")


def test_tables_are_created_once_with_defaults(spark, databases, base):
    raw, _ = databases
    for _ in range(2):
        tables.create_raw_tables(spark, raw, ingestion_time=True)
    load(spark, base, raw)
    study = spark.table(f"{raw}.sleep_studies").where("study_id = 'a'").first()
    assert (study.study_date, study.deep_min, study.sex) == (date(2024, 1, 1), 50.0, "F")
    assert isinstance(study.ingestion_time, datetime)
    assert spark.table(f"{raw}.events_silver").columns[-1] == "ingestion_time"


def test_fixed_point_variant(spark, databases):
    raw, _ = databases
    tables.create_raw_tables(spark, raw, decimals=True)
    kinds = dict(spark.table(f"{raw}.sleep_studies").dtypes)
    assert kinds["rem_min"] == "decimal(10,2)" and kinds["study_date"] == "date"


def test_models_run_and_are_rebuilt_whole(spark, databases, base):
    raw, mart = databases
    load(spark, base, raw)
    for _ in range(2):
        report = models.run(spark, raw, mart)
        assert {r.violations for r in report.collect()} == {0}
        assert spark.table(f"{mart}.fct_sleep_summary").count() == 2
    rates = spark.table(f"{mart}.fct_event_rates").collect()
    assert [(r.study_id, r.total_events, r.apnea_count, r.avg_event_duration_sec) for r in rates] == [("a", 2, 1, 10.5)]
    assert spark.table(f"{mart}.dim_time").count() == 3660
    assert "ingestion_time" not in spark.table(f"{mart}.fct_sleep_summary").columns
    joined = {r.study_id: (r.ahi, r.ahi_severity) for r in models.clinical(spark, mart).collect()}
    assert joined == {"a": (0.2, "Normal"), "b": (0.0, "Normal")}


def test_literal_rate_key_fails_on_a_night_over_midnight(spark, databases, base):
    raw, mart = databases
    with open(f"{base}/events.csv", "a") as out:
        out.write("8,apnea,2024-01-02T01:00:00.000Z,a\n")
    load(spark, base, raw)
    models.run(spark, raw, mart)
    rates = {"fct_event_rates": spark.table(f"{mart}.fct_event_rates")}
    report = models.unique_tests(rates, strict_rate_key=True)
    got = {(r.rule, r.column_name): r.violations for r in report.collect()}
    assert got[("fct_event_rates.unique", "study_id, event_date")] == 0
    assert got[("fct_event_rates.unique", "study_id")] == 1


def test_failed_model_test_stops_the_run(spark, databases, base):
    raw, mart = databases
    with open(f"{base}/studies.csv", "a") as out:
        out.write("71+,40.0,200.0,60.0,M,2024-01-02,b,300.0\n")
    load(spark, base, raw)
    with pytest.raises(QualityGateError, match="stg_sleep_study.unique"):
        models.run(spark, raw, mart)
    assert not spark.catalog.databaseExists(mart)


def test_command_line(spark, databases, base):
    raw, mart = databases
    for table in ("sleep_studies", "events"):
        path = f"{base}/{'studies' if table == 'sleep_studies' else table}.csv"
        assert main(["load", "--database", raw, "--table", table, "--path", path]) == 0
    assert main(["models", "--raw-database", raw, "--database", mart]) == 0
    assert spark.table(f"{mart}.fct_event_rates").count() == 1
    again = ["load", "--database", raw, "--table", "sleep_studies", "--path", f"{base}/studies.csv"]
    assert main(again) == 0
    assert main(["models", "--raw-database", raw, "--database", mart]) == 0
    assert main([*again, "--force"]) == 0
    assert main(["models", "--raw-database", raw, "--database", mart]) == 1


def test_bucketed_facts_join_without_a_shuffle(spark, databases, base):
    raw, mart = databases
    load(spark, base, raw)
    models.run(spark, raw, mart, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = models.clinical(spark, mart)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_unreadable_files_are_not_loaded(spark, databases, base):
    raw, _ = databases
    with open(f"{base}/events.csv", "a") as out:
        out.write("abc,apnea,2024-01-02T01:00:00.000Z,a\n")
    with pytest.raises(tables.UnreadableInput, match="duration_sec: 1"):
        load(spark, base, raw)
    assert spark.table(f"{raw}.events").count() == 0
    tables.load_csv(spark, base, f"{raw}.events", EVENT_SCHEMA, file_pattern=".*events.*", unreadable_ok=True)
    assert spark.table(f"{raw}.events").count() == 3


def test_marts_that_fail_their_tests_keep_the_old_ones(spark, databases, base, monkeypatch):
    raw, mart = databases
    load(spark, base, raw)
    models.run(spark, raw, mart)
    spark.sql(f"INSERT INTO {raw}.sleep_studies VALUES ('c', DATE '2024-01-01', 10, 300, 50, 50, '71+', 'M', NULL)")
    with pytest.raises(QualityGateError, match="stage_sum"):
        models.run(spark, raw, mart)
    assert spark.table(f"{mart}.fct_sleep_summary").count() == 2


@pytest.mark.parametrize("step", ["build_marts", "mart_tests", "publish", "_point_views"])
def test_readers_see_one_run_at_every_step(spark, databases, base, monkeypatch, step):
    """A run killed after each step: all marts are of the old run, or all of the new one."""
    raw, mart = databases
    load(spark, base, raw)
    models.run(spark, raw, mart)
    before = models.published(spark, mart)
    Path(base, "more_events.csv").write_text(EVENT_LINES.replace(",a", ",b"))
    Path(base, "more.csv").write_text(STUDY_LINES.replace(",a,", ",c,").replace(",b,", ",d,"))
    tables.load_csv(spark, f"{base}/more.csv", f"{raw}.sleep_studies", STUDY_SCHEMA)
    tables.load_csv(spark, f"{base}/more_events.csv", f"{raw}.events", EVENT_SCHEMA)
    done = getattr(models, step)

    def dies(*args):
        if step != "_point_views":
            done(*args)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(models, step, dies)
        with pytest.raises(RuntimeError):
            models.run(spark, raw, mart)
    now, new = models.published(spark, mart), step in ("publish", "_point_views")
    assert (now != before) is new
    assert len({t.partition("__")[2] for t in now.values()}) == 1
    counts = [models.mart(spark, mart, name).count() for name in models.MART_FACTS]
    assert counts == ([4, 2] if new else [2, 1])
    models.run(spark, raw, mart)
    assert [spark.table(f"{mart}.{name}").count() for name in models.MART_FACTS] == [4, 2]
    models.vacuum(spark, mart, keep=1)
    left = [t.name for t in spark.catalog.listTables(mart) if "__" in t.name]
    assert sorted(left) == sorted(models.published(spark, mart).values())
    assert models.clinical(spark, mart).count() == 4


def test_features_grow_by_new_epochs(spark, databases, base, monkeypatch):
    raw, mart = databases
    load(spark, base, raw)
    night = lambda ids: spark.createDataFrame(
        [(f"p{i % 2}", i, f"Sleep stage {1 + i % 3}", [float((i * k * k) % 11) for k in range(64)]) for i in ids],
        "subject_id string, epoch_id long, sleep_stage string, samples array<double>",
    )
    computed, power = [], features.band_power
    monkeypatch.setattr(features, "band_power", lambda df, rate: power(computed.append(df.count()) or df, rate))
    for ids in (range(6), range(6), range(10)):
        models.run(spark, raw, mart, epochs=night(ids), sample_rate=128.0)
    assert computed == [6, 0, 4]
    whole = signals.signal_analytics(power(night(range(10)), 128.0))
    rounded = lambda df: sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()])
    assert rounded(models.mart(spark, mart, "fct_signal_analytics")) == rounded(whole)
    assert spark.table("stg_signal_features").count() == 10
    with pytest.raises(ValueError, match="p0/20"):
        models.run(spark, raw, mart, epochs=night([20, 20]), sample_rate=128.0)
    assert spark.table(f"{mart}.fct_signal_analytics").count() == whole.count()


def test_a_killed_growth_adds_nothing(spark, base, monkeypatch):
    epochs = spark.createDataFrame([("p", 1, "s", [1.0, 2.0, 4.0, 1.0])], "subject_id string, epoch_id long, sleep_stage string, samples array<double>")

    def dies(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(features.CommitLog, "commit", dies)
        with pytest.raises(RuntimeError):
            features.grow(spark, epochs, f"{base}/signals", 128.0)
    with pytest.raises(ValueError):
        features.signal_features(spark, f"{base}/signals")
    assert features.grow(spark, epochs, f"{base}/signals", 128.0) == 1
    assert features.signal_features(spark, f"{base}/signals").count() == 1
