from datetime import date, datetime
from pathlib import Path

import pytest

from studymart.__main__ import main
from studymart.operators.quality import QualityGateError
from studymart.plans import medallion
from studymart.sources.files import MissingInput

HEADER = "duration_sec,event_type,study_datetime,study_id\n"


def land(base, day, *lines):
    folder = Path(base, "raw", "events", f"dt={day}")
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part-0.csv").write_text(HEADER + "".join(line + "\n" for line in lines))


def gold(spark, base):
    df = medallion.published(spark, base, "gold")
    return sorted((str(r.dt), r.study_id, str(r.event_date), r.total_events, r.apnea_count) for r in df.collect())


@pytest.fixture
def lake(base):
    land(base, "2024-01-01", "10,apnea,2024-01-01T22:00:00.000Z,a", "12,Apnea,2024-01-02T02:00:00.000Z,a")
    land(base, "2024-01-02", "11,hypopnea,2024-01-02T23:00:00.000Z,a")
    land(base, "2024-01-04", "9,apnea,2024-01-04T23:00:00.000Z,b")
    return base


DAY_1 = [("2024-01-01", "a", "2024-01-01", 1, 1), ("2024-01-01", "a", "2024-01-02", 1, 0)]
DAY_2 = [("2024-01-02", "a", "2024-01-02", 1, 0)]


def test_one_day(spark, lake):
    medallion.run_day(spark, lake, "2024-01-01")
    assert gold(spark, lake) == DAY_1
    silver = medallion.published(spark, lake, "silver").orderBy("study_datetime").collect()
    assert [(r.event_type, r.event_type_norm) for r in silver] == [("apnea", "apnea"), ("Apnea", "other")]
    assert silver[0].study_datetime == datetime(2024, 1, 1, 22)


def test_published_days_are_pruned(spark, lake):
    with pytest.raises(MissingInput):
        medallion.published(spark, lake, "gold")
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    second = medallion.published(spark, lake, "gold", "2024-01-02", "2024-01-09")
    assert second.count() == 1 and len({Path(f).parent.name for f in second.inputFiles()}) == 1
    none = medallion.published(spark, lake, "gold", "2030-01-01")
    assert none.count() == 0 and none.columns == second.columns


def test_range_is_inclusive_and_rerun_changes_nothing(spark, lake):
    for _ in range(2):
        medallion.backfill(spark, lake, date(2024, 1, 1), "2024-01-02")
        assert gold(spark, lake) == DAY_1 + DAY_2


def test_rerun_replaces_only_its_day(spark, lake):
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    land(lake, "2024-01-02", "1,apnea,2024-01-02T22:30:00.000Z,c")
    medallion.run_day(spark, lake, "2024-01-02")
    assert gold(spark, lake) == DAY_1 + [("2024-01-02", "c", "2024-01-02", 1, 1)]


def test_day_that_becomes_empty_is_cleared(spark, lake):
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    land(lake, "2024-01-02")
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    assert gold(spark, lake) == DAY_1
    assert medallion.published(spark, lake, "silver").count() == 2


def test_only_empty_days(spark, base):
    land(base, "2024-01-01")
    medallion.run_day(spark, base, "2024-01-01")
    assert gold(spark, base) == []


def test_missing_day(spark, lake):
    with pytest.raises(MissingInput, match="2024-01-03"):
        medallion.backfill(spark, lake, "2024-01-01", "2024-01-04")
    assert not Path(lake, "silver").exists()
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-04", missing_ok=True)
    assert len(gold(spark, lake)) == 4
    medallion.backfill(spark, lake, "2030-01-01", "2030-01-02", missing_ok=True)


def test_gate_stops_before_gold(spark, lake):
    land(lake, "2024-01-02", "0,apnea,2024-01-02T22:30:00.000Z,c", "5,apnea,2024-01-02T22:30:00.000Z,")
    with pytest.raises(QualityGateError) as error:
        medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    assert error.value.failures == [("not_null", "study_id", 1), ("positive", "duration_sec", 1)]
    assert not Path(lake, "gold").exists() and not Path(lake, "published").exists()


def silver_ids(spark, base):
    return sorted(r.study_id for r in medallion.published(spark, base, "silver").collect())


def test_a_failed_gate_leaves_both_layers(spark, lake):
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    land(lake, "2024-01-02", "0,apnea,2024-01-02T22:30:00.000Z,c")
    with pytest.raises(QualityGateError):
        medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    assert gold(spark, lake) == DAY_1 + DAY_2 and silver_ids(spark, lake) == ["a", "a", "a"]


@pytest.mark.parametrize("step", ["write_silver", "write_gold", "_publish"])
def test_a_killed_run_leaves_both_layers(spark, lake, monkeypatch, step):
    """Killed after each of its writes, and before its commit; then a rerun is complete."""
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    land(lake, "2024-01-02", "1,apnea,2024-01-02T22:30:00.000Z,c")
    done = getattr(medallion, step)

    def dies(*args):
        if step != "_publish":
            done(*args)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(medallion, step, dies)
        with pytest.raises(RuntimeError):
            medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    assert gold(spark, lake) == DAY_1 + DAY_2 and silver_ids(spark, lake) == ["a", "a", "a"]
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    assert gold(spark, lake) == DAY_1 + [("2024-01-02", "c", "2024-01-02", 1, 1)]
    assert silver_ids(spark, lake) == ["a", "a", "c"]


def test_runs_at_the_same_time(spark, lake, monkeypatch):
    """Other days are merged; of two runs over one day the slower one fails."""
    write, runs = medallion.write_gold, []

    def meanwhile(day):
        def slow(*args):
            write(*args)
            if not runs:
                runs.append(day)
                medallion.run_day(spark, lake, day)

        return slow

    monkeypatch.setattr(medallion, "write_gold", meanwhile("2024-01-02"))
    medallion.run_day(spark, lake, "2024-01-01")
    assert gold(spark, lake) == DAY_1 + DAY_2
    runs.clear()
    with pytest.raises(medallion.CommitConflict):
        medallion.run_day(spark, lake, "2024-01-02")


def test_vacuum_keeps_what_is_published(spark, lake):
    for _ in range(3):
        medallion.backfill(spark, lake, "2024-01-01", "2024-01-02")
    medallion.run_day(spark, lake, "2024-01-02")
    medallion.vacuum(spark, lake, keep=1)
    assert gold(spark, lake) == DAY_1 + DAY_2
    kept = sorted(p.name for p in Path(lake, "gold", "events").glob("attempt=*/dt=*"))
    assert kept == ["dt=2024-01-01", "dt=2024-01-02"]


def test_a_late_file_rereads_only_itself(spark, lake):
    assert [str(d) for d in medallion.refresh(spark, lake)] == ["2024-01-01", "2024-01-02", "2024-01-04"]
    assert medallion.refresh(spark, lake) == []
    late = Path(lake, "raw", "events", "dt=2024-01-02", "late file.csv")
    late.write_text(HEADER + "7,apnea,2024-01-02T22:00:00.000Z,a\n,apnea,2024-01-02T22:10:00.000Z,a\n")
    assert [str(d) for d in medallion.refresh(spark, lake)] == ["2024-01-02"]
    files = medallion.Ledger(spark, medallion.folder(lake, "states")).files().collect()
    last = max(files, key=lambda r: r.changed_at).load_id
    assert [Path(r.path).name for r in files if r.load_id == last] == ["late file.csv"]
    incremental = sorted(map(tuple, medallion.published(spark, lake, "gold").collect()), key=str)
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-04", missing_ok=True)
    assert incremental == sorted(map(tuple, medallion.published(spark, lake, "gold").collect()), key=str)
    assert ("a", 9.0) in [(r[0], r.avg_event_duration_sec) for r in medallion.published(spark, lake, "gold").collect()]


def test_changed_removed_and_empty_files(spark, lake):
    medallion.refresh(spark, lake)
    land(lake, "2024-01-02", "1,apnea,2024-01-02T22:30:00.000Z,c", "1,apnea,2024-01-02T22:30:00.000Z,c")
    Path(lake, "raw", "events", "dt=2024-01-04", "part-0.csv").unlink()
    land(lake, "2024-01-05")
    assert [str(d) for d in medallion.refresh(spark, lake)] == ["2024-01-02", "2024-01-04", "2024-01-05"]
    assert gold(spark, lake) == DAY_1 + [("2024-01-02", "c", "2024-01-02", 2, 2)]
    land(lake, "2024-01-02", "0,apnea,2024-01-02T22:30:00.000Z,c")
    with pytest.raises(QualityGateError):
        medallion.refresh(spark, lake)
    assert gold(spark, lake) == DAY_1 + [("2024-01-02", "c", "2024-01-02", 2, 2)]
    land(lake, "2024-01-02", "3,apnea,2024-01-02T22:30:00.000Z,d")
    medallion.refresh(spark, lake)
    assert gold(spark, lake) == DAY_1 + [("2024-01-02", "d", "2024-01-02", 1, 1)]


def test_calendar_counts_empty_days(spark, lake):
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-04", missing_ok=True)
    silver = medallion.published(spark, lake, "silver")
    calendar = medallion.backfill_calendar(silver, "2024-01-01", "2024-01-05").orderBy("dt")
    assert [(str(r.dt), r.event_rows) for r in calendar.collect()] == [
        ("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 0), ("2024-01-04", 1), ("2024-01-05", 0),
    ]


def test_command_line(spark, lake):
    assert main(["run-day", "--base", lake, "--date", "2024-01-01"]) == 0
    assert main(["backfill", "--base", lake, "--start", "2024-01-01", "--end", "2024-01-04", "--missing-ok"]) == 0
    assert main(["check", "--path", f"{lake}/silver/events"]) == 0
    assert main(["check", "--path", f"{lake}/nowhere"]) == 1
    land(lake, "2024-01-02", "-3,apnea,2024-01-02T22:30:00.000Z,c")
    assert main(["run-day", "--base", lake, "--date", "2024-01-02"]) == 1


def test_unreadable_values_stop_at_the_gate(spark, base):
    land(base, "2024-01-01", "abc,apnea,not a time,a", "1,2,3", "5,apnea,2024-01-01T22:00:00.000Z,a")
    with pytest.raises(QualityGateError) as caught:
        medallion.run_day(spark, base, "2024-01-01")
    assert ("readable", "rejected_fields", 2) in caught.value.failures
    assert not Path(base, "gold").exists()
    listed = {tuple(r.rejected_fields) for r in spark.read.parquet(caught.value.attempt).collect()}
    assert ("duration_sec", "study_datetime") in listed and () in listed


def test_unreadable_values_may_be_let_through(spark, base):
    land(base, "2024-01-01", "abc,apnea,2024-01-01T22:00:00.000Z,a")
    medallion.backfill(spark, base, "2024-01-01", "2024-01-01", unreadable_ok=True)
    assert gold(spark, base) == [("2024-01-01", "a", "2024-01-01", 1, 1)]


def test_rows_without_a_day_stop_the_run(spark, lake):
    folder = Path(lake, "raw", "events", "dt=__HIVE_DEFAULT_PARTITION__")
    folder.mkdir()
    (folder / "part-0.csv").write_text(HEADER + "1,apnea,,x\n")
    with pytest.raises(QualityGateError, match="dated"):
        medallion.run_day(spark, lake, "2024-01-01")
    medallion.backfill(spark, lake, "2024-01-01", "2024-01-01", undated_ok=True)
    assert gold(spark, lake) == DAY_1


def test_offsets_move_the_date(spark, base):
    land(base, "2024-01-01", "10,apnea,2024-01-01T23:30:00-05:00,a")
    medallion.run_day(spark, base, "2024-01-01")
    row = medallion.published(spark, base, "silver").first()
    assert (row.study_datetime, row.event_date) == (datetime(2024, 1, 2, 4, 30), date(2024, 1, 2))
