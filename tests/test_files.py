from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from studymart.contracts import EVENT_SCHEMA, STUDY_SCHEMA, as_text
from studymart.operators.staging import bronze_to_silver
from studymart.sources import files

ROWS = [
    ("1", "apnea", 12.5, datetime(2024, 1, 1, 22, 0, 0, 123456)),
    ("2", None, 0.1, datetime(2024, 1, 2, 2)),
    ('say "hi", you', "other", None, None),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def write(folder, name, text):
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, name).write_text(text)


def test_csv_round_trip_and_overwrite(spark, frame, base):
    events = frame(ROWS, EVENT_SCHEMA)
    for _ in range(2):
        files.write_landing_csv(events, f"{base}/landed")
    back = files.scan_csv(spark, f"{base}/landed", EVENT_SCHEMA)
    assert back.schema == EVENT_SCHEMA
    assert rows(back) == sorted(ROWS, key=str)
    header = next(Path(base, "landed").glob("*.csv")).read_text().splitlines()[0]
    assert header == "duration_sec,event_type,study_datetime,study_id"


def test_columns_go_by_name(spark, base):
    write(base, "a.csv", "study_id,study_datetime,duration_sec,event_type\n7,2024-01-01 22:00:00,3,apnea\n")
    got = files.scan_csv(spark, base, EVENT_SCHEMA).first()
    assert tuple(got) == ("7", "apnea", 3.0, datetime(2024, 1, 1, 22))


def test_a_differing_header_fails_the_scan(spark, base):
    write(base, "a.csv", "duration_sec,event_type,study_datetime,study_id\n1,apnea,,1\n")
    write(base, "b.csv", "event_type,duration_sec,study_datetime,study_id\napnea,1,,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_csv(spark, base, EVENT_SCHEMA).collect()


def test_null_tokens_and_quotes(spark, base):
    write(base, "a.csv", 'duration_sec,event_type,study_datetime,study_id\nNULL,null,"",1\n,"apnea",,""\n2,Null,,x\n')
    assert rows(files.scan_csv(spark, base, EVENT_SCHEMA)) == rows_of(
        ("1", None, None, None), (None, "apnea", None, None), ("x", "Null", 2.0, None)
    )
    kept = files.scan_csv(spark, base, EVENT_SCHEMA, null_tokens=["-"])
    assert "NULL" not in {r.event_type for r in kept.collect()}
    assert "null" in {r.event_type for r in kept.collect()}


def rows_of(*tuples):
    return sorted(tuples, key=str)


def test_rejects_keep_every_bad_value_in_sight(spark, base):
    write(
        base,
        "a.csv",
        "duration_sec,event_type,study_datetime,study_id\n"
        "abc,apnea,2024-01-01 22:00:00,1\n"
        "2,apnea,yesterday,2\n"
        "3,apnea,2024-01-01 22:00:00,3\n"
        "4,apnea\n",
    )
    got = files.scan_csv(spark, base, EVENT_SCHEMA, rejects="rejected")
    assert {r.duration_sec if r.study_id is None else r.study_id: r.rejected for r in got.collect()} == {
        "1": ["duration_sec"],
        "2": ["study_datetime"],
        "3": [],
        4.0: ["_corrupt_record"],
    }
    # The malformed line is found whichever columns a query reads.
    assert got.select("rejected").where("size(rejected) > 0").count() == 3


def test_missing_path(spark, base):
    with pytest.raises(files.MissingInput):
        files.scan_csv(spark, f"{base}/none", EVENT_SCHEMA)
    with pytest.raises(files.MissingInput):
        files.scan_parquet(spark, f"{base}/none", EVENT_SCHEMA)
    assert files.scan_csv(spark, f"{base}/none", EVENT_SCHEMA, missing_ok=True).count() == 0
    assert files.scan_parquet(spark, f"{base}/none", EVENT_SCHEMA, missing_ok=True).count() == 0


def test_files_chosen_by_name(spark, base):
    line = "age_group,deep_min,light_min,rem_min,sex,study_date,study_id,total_sleep_time_min\n,,,,,,{},\n"
    write(base, "sleep_summary_1.csv", line.format("yes"))
    write(base, "notes.csv", line.format("no"))
    write(base, "a_first.csv", "other,columns\n1,2\n")
    by_pattern = files.scan_csv(spark, base, STUDY_SCHEMA, file_pattern=".*sleep_summary.*")
    assert [r.study_id for r in by_pattern.collect()] == ["yes"]
    with pytest.raises(files.MissingInput):
        files.scan_csv(spark, base, STUDY_SCHEMA, file_pattern=".*nothing.*")
    by_glob = files.scan_csv(spark, base, STUDY_SCHEMA, glob="sleep_*.csv")
    assert [r.study_id for r in by_glob.collect()] == ["yes"]


def test_text_columns_of_a_contract():
    assert set(f.dataType.simpleString() for f in as_text(STUDY_SCHEMA).fields) == {"string"}


@pytest.fixture
def silver(frame):
    day = datetime(2024, 1, 1, 22)
    events = frame([(str(i), "apnea", 1.0, day.replace(day=1 + i % 3)) for i in range(30)], EVENT_SCHEMA)
    silver = bronze_to_silver(events)
    return silver.withColumn("dt", silver.event_date)


def test_days_are_replaced_one_by_one(spark, silver, base):
    files.write_days(silver, base, rebalance=True)
    files.write_days(silver, base)
    assert spark.read.parquet(base).count() == 30
    files.write_days(silver.where("event_date = '2024-01-02' and study_id = '1'"), base)
    counts = dict(spark.read.parquet(base).groupBy("dt").count().collect())
    assert counts == {date(2024, 1, 1): 10, date(2024, 1, 2): 1, date(2024, 1, 3): 10}


def test_days_are_pruned(spark, silver, base):
    files.write_days(silver, base)
    two = files.read_days(spark, base, date(2024, 1, 2), date(2024, 1, 9))
    assert len({Path(f).parent.name for f in two.inputFiles()}) == 2
    assert two.count() == 20 and "dt" in two.columns
    plan = spark.read.parquet(base).where("dt = '2024-01-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    with pytest.raises(files.MissingInput):
        files.read_days(spark, base, date(2025, 1, 1), date(2025, 1, 2))


def test_rows_without_a_day_do_not_hide_the_others(spark, silver, base):
    undated = silver.limit(1).withColumn("dt", F.lit(None).cast("date"))
    files.write_days(silver.unionByName(undated), base)
    assert len(files.landed_days(spark, base, date.min, date.max)) == 3
    assert spark.read.parquet(base).count() == 31


def test_a_heavy_day_is_written_as_several_files(spark, base):
    heavy = spark.range(0, 200_000, 1, 8).selectExpr(
        "id", "sha2(cast(id as string), 512) as filler", "date'2024-01-01' as dt"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        files.write_days(heavy, base, rebalance=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(Path(base, "dt=2024-01-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(base).count() == 200_000


def test_scan_any(spark, frame, base):
    events = frame(ROWS, EVENT_SCHEMA)
    events.write.parquet(f"{base}/p")
    files.write_landing_csv(events, f"{base}/c")
    assert rows(files.scan_any(spark, f"{base}/p")) == rows(files.scan_any(spark, f"{base}/c"))
    write(f"{base}/slim", "a.csv", "study_id\n1\n")
    assert files.scan_any(spark, f"{base}/slim").columns == ["study_id"]
    Path(base, "void").mkdir()
    with pytest.raises(files.MissingInput):
        files.scan_any(spark, f"{base}/void")


def test_scan_any_looks_at_every_file(spark, frame, base):
    events = frame([("a",)], "study_id string")
    events.write.parquet(f"{base}/mixed")
    files.write_landing_csv(events, f"{base}/mixed/more")
    with pytest.raises(ValueError, match="both"):
        files.scan_any(spark, f"{base}/mixed")
    files.write_landing_csv(events, f"{base}/csv")
    events.write.parquet(f"{base}/csv/_temporary/0")
    assert files.scan_any(spark, f"{base}/csv").count() == 1
