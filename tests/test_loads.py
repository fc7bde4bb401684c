"""Load ledgers, commits, and records with line breaks."""

import csv
import io
import os
import random
from datetime import datetime
from pathlib import Path

import pytest

from studymart.contracts import EVENT_SCHEMA
from studymart.sources import files, ledger, records, tables
from studymart.sources.commits import CommitConflict, CommitLog
from studymart.streaming.ingest import ingest_once, loaded

HEADER = "duration_sec,event_type,study_datetime,study_id\n"


def land(base, name, *ids):
    path = Path(base, "landed", name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(HEADER + "".join(f"1.5,apnea,2024-01-01 22:00:00,{i}\n" for i in ids))
    return path


@pytest.fixture
def raw(spark):
    tables.create_raw_tables(spark, "raw_loads", ingestion_time=True)
    yield "raw_loads.events"
    spark.sql("DROP DATABASE raw_loads CASCADE")


def load(spark, base, raw, **options):
    return tables.load_csv(spark, f"{base}/landed", raw, EVENT_SCHEMA, **options)


def ids(spark, raw):
    return sorted(r.study_id for r in spark.table(raw).collect())


# --- Commits ------------------------------------------------------------------


def test_a_number_is_taken_once(spark, base):
    log = CommitLog(spark, base)
    assert log.latest() == (0, {})
    log.commit(1, {"a": 1})
    with pytest.raises(CommitConflict):
        log.commit(1, {"a": 2})
    log.commit(2, {"a": "ü"})
    assert log.versions() == [1, 2] and log.latest() == (2, {"a": "ü"})
    assert sorted(p.name for p in Path(base).iterdir() if not p.name.startswith(".")) == [f"{n:020d}.json" for n in (1, 2)]


# --- Tables that know what they loaded ----------------------------------------------


def test_files_are_loaded_once(spark, base, raw):
    land(base, "a.csv", "1", "2")
    assert load(spark, base, raw) == 1
    assert load(spark, base, raw) == 0
    land(base, "dt=2024-01-02/b.csv", "3")
    assert load(spark, f"{base}", raw, files_per_load=1) == 1
    assert ids(spark, raw) == ["1", "2", "3"]
    assert isinstance(spark.table(raw).first().ingestion_time, datetime)
    known = tables.loaded_files(spark, raw).collect()
    assert {Path(r.path).name: r.length for r in known} == {
        "a.csv": Path(base, "landed/a.csv").stat().st_size,
        "b.csv": Path(base, "landed/dt=2024-01-02/b.csv").stat().st_size,
    }
    assert len({r.load_id for r in known}) == 2


def test_a_changed_file_is_told(spark, base, raw):
    path = land(base, "a.csv", "1")
    land(base, "b.csv", "2")
    load(spark, base, raw)
    land(base, "a.csv", "1", "9")
    land(base, "c.csv", "3")
    with pytest.raises(ledger.ChangedInput, match="a.csv"):
        load(spark, base, raw)
    assert ids(spark, raw) == ["1", "2"]
    assert load(spark, base, raw, changed="skip") == 1
    assert ids(spark, raw) == ["1", "2", "3"]
    assert load(spark, base, raw, changed="append") == 1
    assert ids(spark, raw) == ["1", "1", "2", "3", "9"]
    os.utime(path, (1, 1))  # the same length, another time
    with pytest.raises(ledger.ChangedInput):
        load(spark, base, raw)
    assert load(spark, base, raw, force=True) == 3


def test_a_backlog_goes_in_several_loads(spark, base, raw):
    for i in range(5):
        land(base, f"{i}.csv", str(i))
    assert load(spark, base, raw, files_per_load=2) == 5
    assert ids(spark, raw) == list("01234")
    root = tables.table_location(spark, raw)
    assert len(CommitLog(spark, f"{root}/_ledger").versions()) == 3


def test_a_load_that_dies_before_its_commit_leaves_nothing(spark, base, raw, monkeypatch):
    land(base, "a.csv", "1")

    def dies(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", dies)
        with pytest.raises(RuntimeError):
            load(spark, base, raw)
    assert ids(spark, raw) == [] and tables.loaded_files(spark, raw).count() == 0
    assert load(spark, base, raw) == 1 and ids(spark, raw) == ["1"]


def test_a_load_that_dies_after_its_commit_is_completed(spark, base, raw, monkeypatch):
    land(base, "a.csv", "1")
    with monkeypatch.context() as patch:
        patch.setattr(ledger.Ledger, "_publish", lambda *args: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            load(spark, base, raw)
    assert ids(spark, raw) == []
    assert load(spark, base, raw) == 0
    spark.catalog.refreshTable(raw)
    assert ids(spark, raw) == ["1"]


def test_two_loaders_of_one_file(spark, base, raw, monkeypatch):
    """The slower to commit finds its number taken and its file loaded."""
    land(base, "a.csv", "1")
    versions, asked = CommitLog.versions, []

    def stale(log):
        asked.append(log)
        return versions(log) if len(asked) > 1 else []  # before the faster one committed

    fresh = ledger.Ledger(spark, tables.table_location(spark, raw))
    found = ledger.list_files(spark, f"{base}/landed")
    load(spark, base, raw)
    spark.createDataFrame([("x",)], "study_id string").write.parquet(fresh.staged("slow"))
    monkeypatch.setattr(CommitLog, "versions", stale)
    with pytest.raises(ledger.ConcurrentLoad):
        fresh.commit("slow", found)
    monkeypatch.undo()
    assert ids(spark, raw) == ["1"] and load(spark, base, raw) == 0


def test_unreadable_rows_stage_nothing(spark, base, raw):
    land(base, "a.csv", "1")
    with open(Path(base, "landed", "a.csv"), "a") as out:
        out.write("abc,apnea,,2\n")
    with pytest.raises(tables.UnreadableInput, match="duration_sec: 1"):
        load(spark, base, raw)
    assert ids(spark, raw) == [] and tables.loaded_files(spark, raw).count() == 0
    assert load(spark, base, raw, unreadable_ok=True) == 1


def test_nothing_to_load(spark, base, raw):
    with pytest.raises(files.MissingInput):
        load(spark, base, raw)
    land(base, "a.csv")
    with pytest.raises(files.MissingInput):
        load(spark, base, raw, file_pattern=".*none.*")
    assert load(spark, base, raw) == 1 and ids(spark, raw) == []


def test_a_new_checkpoint_adds_nothing(spark, base):
    land(base, "a.csv", "1")
    for name in ("one", "two", "one"):
        ingest_once(spark, f"{base}/landed", f"{base}/events", f"{base}/check-{name}", EVENT_SCHEMA)
        assert [r.study_id for r in loaded(spark, f"{base}/events", EVENT_SCHEMA).collect()] == ["1"]
    land(base, "b.csv", "2")
    ingest_once(spark, f"{base}/landed", f"{base}/events", f"{base}/check-two", EVENT_SCHEMA)
    ingest_once(spark, f"{base}/landed", f"{base}/events", f"{base}/check-one", EVENT_SCHEMA)
    assert sorted(r.study_id for r in loaded(spark, f"{base}/events", EVENT_SCHEMA).collect()) == ["1", "2"]


def test_a_new_checkpoint_tells_of_a_changed_file(spark, base):
    land(base, "a.csv", "1")
    ingest_once(spark, f"{base}/landed", f"{base}/events", f"{base}/check-one", EVENT_SCHEMA)
    land(base, "a.csv", "1", "2")
    with pytest.raises(Exception, match="changed since they were loaded"):
        ingest_once(spark, f"{base}/landed", f"{base}/events", f"{base}/check-two", EVENT_SCHEMA)
    assert loaded(spark, f"{base}/events", EVENT_SCHEMA).count() == 1


# --- Records with line breaks ---------------------------------------------------------

FIELDS = ["plain", "", 'say "hi"', "a,b", "one\ntwo", "\n", '"\n",\n"', "x" * 60, "end\n", "né"]


def drawn_file(rng, rows):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
    writer.writerow(["first", "second"])
    kept = [(rng.choice(FIELDS) + str(i), rng.choice(FIELDS)) for i in range(rows)]
    writer.writerows(kept)
    return out.getvalue(), [(a, b or None) for a, b in kept]


@pytest.mark.parametrize("split", ["40b", "97b", "1k", "1m"])
def test_records_are_whole_however_files_are_split(spark, base, split):
    rng = random.Random(split)
    expected = []
    for i in range(4):
        text, kept = drawn_file(rng, 60)
        Path(base, f"{i}.csv").write_text(text, newline="")
        expected += kept
    Path(base, "plain.csv").write_text("first,second\np,q\n")
    expected.append(("p", "q"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        rows = files.scan_csv_text(spark, base, line_breaks=True)
        tasks, got = rows.rdd.getNumPartitions(), rows.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert all(r[files.CORRUPT] is None for r in got)
    assert sorted((r.first, r.second or "") for r in got) == sorted((a, b or "") for a, b in expected)
    assert split == "1m" or tasks > 4


@pytest.mark.parametrize(
    "line, inside, ends",
    [
        ("a,b", False, False), ("a,b", True, True), ('"a,b', False, True), ('a",b', True, False), ('"a""b', False, True),
        ('"a""b"', False, False), ('5" pipe,6"', False, False), ('"a"x"y,z', False, False), ('a,"', False, True), ('",""', True, False),
        ('""', True, True), ('"', True, False), ('"""', False, True), (",,", False, False), ('"a","b', False, True), ("", True, True),
    ],
)
def test_state_after_a_line(line, inside, ends):
    assert records.ends_inside(line, inside) is ends


def test_files_without_line_breaks_are_scanned_as_before(spark, base):
    Path(base, "a.csv").write_text('first,second\n"x, ""y""",2\n')
    assert records.split_records(spark, [base], ["first", "second"]) is None
    assert tuple(files.scan_csv_text(spark, base, line_breaks=True).first())[:2] == ('x, "y"', "2")


def test_malformed_records_and_headers(spark, base):
    Path(base, "a.csv").write_text('first,second\n"x\ny",2\n1,2,3\n\n"open\nto the end')
    got = files.scan_csv_text(spark, base, line_breaks=True).collect()
    assert sorted((r.first or "", r[files.CORRUPT] is None) for r in got)[-1] == ("x\ny", True)
    assert sum(r[files.CORRUPT] is not None for r in got) == 2
    Path(base, "b.csv").write_text("second,first\n1,2\n")
    with pytest.raises(Exception, match="header"):
        files.scan_csv_text(spark, base, header=["first", "second"], line_breaks=True).collect()


def test_a_quote_that_nothing_closes_is_told(spark, base, monkeypatch):
    monkeypatch.setattr(records, "RECORD_CHARS", 100)
    Path(base, "a.csv").write_text('first,second\n"x,2\n' + "1,2\n" * 50)
    with pytest.raises(Exception, match="isn't closed"):
        files.scan_csv_text(spark, base, line_breaks=True).collect()


def test_line_breaks_in_day_folders(spark, base):
    Path(base, "dt=2024-01-02").mkdir()
    Path(base, "dt=2024-01-02", "a.csv").write_text('first\n"x\ny"\n')
    row = files.scan_csv_text(spark, base, line_breaks=True).first()
    assert (row.first, str(row.dt)) == ("x\ny", "2024-01-02")


def test_load_with_line_breaks(spark, base, raw):
    Path(base, "landed").mkdir()
    Path(base, "landed", "a.csv").write_text(HEADER + '1.5,"ap\nnea",2024-01-01 22:00:00,"s, ""1"""\r\n2,x,,2\n')
    assert load(spark, base, raw) == 1
    got = {r.study_id: (r.event_type, r.study_datetime) for r in spark.table(raw).collect()}
    assert got == {'s, "1"': ("ap\nnea", datetime(2024, 1, 1, 22)), "2": ("x", None)}
