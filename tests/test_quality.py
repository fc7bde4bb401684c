from pathlib import Path

import pytest


from studymart.contracts import (
    EVENT_SCHEMA,
    EVENT_TYPES,
    REQUIRED_EVENT_COLUMNS,
    STUDY_SCHEMA,
)
from studymart import contracts
from studymart.operators import quality
from studymart.operators.marts import fct_sleep_summary


def report(df):
    return {(r.rule, r.column_name): r.violations for r in df.collect()}


EVENTS = "study_id string, duration_sec bigint"


def test_event_rules(frame):
    df = frame([("1", 100), (None, 5), ("2", 0), ("3", -1), ("4", None)], EVENTS)
    assert report(quality.rule_report(df, quality.EVENT_RULES)) == {
        ("not_null", "study_id"): 1,
        ("positive", "duration_sec"): 2,
    }


def test_rule_for_an_absent_column_is_left_out(frame):
    df = frame([("1",)], "study_id string")
    assert report(quality.rule_report(df, quality.EVENT_RULES)) == {("not_null", "study_id"): 0}
    none = quality.rule_report(df, [quality.positive("duration_sec")])
    assert none.columns == ["rule", "column_name", "violations"] and none.count() == 0


def test_unique_leaves_null_keys_out(frame):
    df = frame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "k string, d int")
    assert report(quality.unique_report(df, ["k"])) == {("unique", "k"): 1}
    assert report(quality.unique_report(df, ["k", "d"])) == {("unique", "k, d"): 0}


def test_accepted_values(frame):
    df = frame([("apnea",), ("Apnea",), ("Apnea",), ("snore",), (None,)], "event_type string")
    rule = quality.accepted_values("event_type", EVENT_TYPES)
    assert report(quality.rule_report(df, [rule])) == {("accepted_values", "event_type"): 3}
    rest = quality.unaccepted_values(df, "event_type", EVENT_TYPES)
    assert sorted(tuple(r) for r in rest.collect()) == [("Apnea", 2), ("snore", 1)]


def test_contract(frame):
    df = frame(
        [("1", None, "abc", "2024-01-01T22:00:00Z"), (None, "apnea", None, "never"), ("2", "x", "1.5", None)],
        "study_id string, event_type string, duration_sec string, study_datetime string",
    )
    rules = quality.contract_rules(EVENT_SCHEMA, REQUIRED_EVENT_COLUMNS, "events")
    assert report(quality.rule_report(df, rules)) == {
        ("events.required", "study_id"): 1,
        ("events.required", "event_type"): 1,
        ("events.number", "duration_sec"): 1,
        ("events.timestamp_ntz", "study_datetime"): 1,
    }


def test_stage_sum_buffer(frame):
    nights = [("ok", 100.0, 101.0), ("over", 100.0, 101.5), ("none", None, 101.5)]
    studies = frame(
        [(i, None, total, rem, 0.0, 0.0, None, None) for i, total, rem in nights], STUDY_SCHEMA
    )
    offending = quality.stage_sum_violations(fct_sleep_summary(studies))
    assert [r.study_id for r in offending.collect()] == ["over"]


def test_gate(frame):
    settled = quality.require(quality.rule_report(frame([("1", 1)], EVENTS), quality.EVENT_RULES))
    assert report(settled) == {("not_null", "study_id"): 0, ("positive", "duration_sec"): 0}
    with pytest.raises(quality.QualityGateError) as error:
        quality.require(quality.rule_report(frame([("1", -1)], EVENTS), quality.EVENT_RULES))
    assert error.value.failures == [("positive", "duration_sec", 1)]


def test_check_path(spark, frame, base):
    frame([("1", 100), ("2", 200)], EVENTS).write.parquet(f"{base}/good")
    frame([(None, 100)], EVENTS).write.parquet(f"{base}/null_id")
    # Text must be typed before it is compared: 0.5 passes, -0.5 does not.
    frame([("1", "0.5")], "study_id string, duration_sec string").write.option("header", True).csv(f"{base}/csv")
    frame([("1", "-0.5")], "study_id string, duration_sec string").write.option("header", True).csv(f"{base}/bad")
    assert quality.check_path(spark, f"{base}/good")
    assert not quality.check_path(spark, f"{base}/null_id")
    assert quality.check_path(spark, f"{base}/csv")
    assert not quality.check_path(spark, f"{base}/bad")
    assert not quality.check_path(spark, f"{base}/absent")


def test_unreadable_csv_fails_the_path_check(spark, base):
    Path(base, "e.csv").write_text("duration_sec,event_type,study_datetime,study_id\nabc,apnea,2024-01-01T22:00:00.000Z,a\n")
    assert not quality.check_path(spark, base)


def test_null_markers_count_alike_in_contract_and_types(frame):
    df = frame([("NULL", "apnea", "null", ""), ("a", "", "x", "2024-01-01 00:00:00")], "study_id string, event_type string, duration_sec string, study_datetime string")
    rules = quality.contract_rules(contracts.EVENT_SCHEMA, contracts.REQUIRED_EVENT_COLUMNS, "events")
    got = {(r.rule, r.column_name): r.violations for r in quality.rule_report(df, rules).collect()}
    assert got[("events.required", "study_id")] == 1 and got[("events.required", "event_type")] == 1
    assert got[("events.number", "duration_sec")] == 1 and got[("events.timestamp_ntz", "study_datetime")] == 0


def test_what_cannot_be_read_fails_the_check(spark, frame, base):
    frame([("a", 1.0)], "study_id string, duration_sec double").write.parquet(f"{base}/good")
    assert quality.check_path(spark, f"{base}/good")
    damaged = Path(base, "damaged")
    damaged.mkdir()
    (damaged / "part-0.parquet").write_bytes(b"not a parquet file")
    assert not quality.check_path(spark, str(damaged))
    whole = next(Path(base, "good").glob("*.parquet")).read_bytes()
    (damaged / "part-0.parquet").write_bytes(whole[: len(whole) // 2])
    assert not quality.check_path(spark, str(damaged))
    mixed = Path(base, "mixed")
    mixed.mkdir()
    (mixed / "a.parquet").write_bytes(whole)
    (mixed / "b.csv").write_text("study_id\n1\n")
    assert not quality.check_path(spark, str(mixed))
    assert not quality.check_path(spark, f"{base}/nowhere")
