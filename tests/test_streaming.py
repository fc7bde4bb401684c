import time
from pathlib import Path

from studymart.contracts import EVENT_SCHEMA
from studymart.streaming.ingest import ingest_once, loaded

HEADER = "duration_sec,event_type,study_datetime,study_id\n"


def land(base, day, name, *ids):
    folder = Path(base, "landed", f"dt={day}")
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(HEADER + "".join(f"1.5,apnea,2024-01-01 22:00:00,{i}\n" for i in ids))


def ingest(spark, base, **options):
    ingest_once(spark, f"{base}/landed", f"{base}/events", f"{base}/checkpoint", EVENT_SCHEMA, **options)
    return sorted(str(r.study_id) for r in loaded(spark, f"{base}/events", EVENT_SCHEMA).collect())


def test_each_file_is_loaded_once(spark, base):
    land(base, "2024-01-01", "a.csv", "1", "2")
    assert ingest(spark, base) == ["1", "2"]
    assert ingest(spark, base) == ["1", "2"]
    land(base, "2024-01-02", "b.csv", "3")
    assert ingest(spark, base) == ["1", "2", "3"]
    row = loaded(spark, f"{base}/events", EVENT_SCHEMA).first()
    assert (row.event_type, row.duration_sec) == ("apnea", 1.5)


def test_long_backlog_is_split_into_batches(spark, base):
    for i in range(5):
        land(base, "2024-01-01", f"{i}.csv", str(i))
    assert ingest(spark, base, files_per_batch=2) == list("01234")
    assert len(list(Path(base, "events").glob("load_id=*"))) == 3


def test_glob_and_purge(spark, base):
    land(base, "2024-01-01", "events-1.csv", "1")
    land(base, "2024-01-01", "notes-1.csv", "9")
    assert ingest(spark, base, glob="events*.csv", purge=True) == ["1"]
    land(base, "2024-01-01", "events-2.csv", "2")
    assert ingest(spark, base, glob="events*.csv", purge=True) == ["1", "2"]
    first = Path(base, "landed", "dt=2024-01-01", "events-1.csv")
    for _ in range(50):
        if not first.exists():
            break
        time.sleep(0.1)
    assert not first.exists()
    assert Path(base, "landed", "dt=2024-01-01", "notes-1.csv").exists()


def test_bad_lines_are_kept_in_sight(spark, base):
    land(base, "2024-01-01", "a.csv", "1")
    with open(Path(base, "landed", "dt=2024-01-01", "a.csv"), "a") as out:
        out.write("abc,apnea,2024-01-01 22:00:00,2\n3,apnea\n")
    ingest(spark, base, rejects="rejected")
    got = loaded(spark, f"{base}/events", EVENT_SCHEMA, "rejected").collect()
    assert sorted(r.rejected for r in got) == [[], ["_corrupt_record"], ["duration_sec"]]


def test_a_second_source_adds_rows(spark, base):
    assert loaded(spark, f"{base}/events", EVENT_SCHEMA).count() == 0
    for name in ("one", "two"):
        folder = Path(base, name)
        folder.mkdir()
        (folder / "f.csv").write_text(f"duration_sec,event_type,study_datetime,study_id\n1,apnea,2024-01-01T22:00:00.000Z,{name}\n")
        for _ in range(2):
            ingest_once(spark, str(folder), f"{base}/events", f"{base}/check-{name}", EVENT_SCHEMA)
    assert sorted(r.study_id for r in loaded(spark, f"{base}/events", EVENT_SCHEMA).collect()) == ["one", "two"]
