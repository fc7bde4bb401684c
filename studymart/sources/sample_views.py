"""Study-shaped views over the test tables, for tests, bench and result checks.

The texts are plain SQL with equal results in Spark (session zone UTC) and DuckDB. Each is a
row-wise projection of one table, so column pruning reaches the Parquet scan.
"""

from pyspark.sql import DataFrame, SparkSession

RAW_SLEEP_STUDIES = """
SELECT study_id, study_date, tst AS total_sleep_time_min,
       round(tst * rem_pct / 100, 1) AS rem_min,
       round(tst * deep_pct / 100, 1) AS deep_min,
       round(tst - round(tst * rem_pct / 100, 1) - round(tst * deep_pct / 100, 1), 1) AS light_min,
       age_group, sex
FROM (SELECT concat('STUDY_', lpad(CAST(c_custkey AS STRING), 9, '0')) AS study_id,
             DATE '2024-01-01' + CAST(c_custkey % 30 AS INT) AS study_date,
             CAST(CASE WHEN c_custkey % 97 = 0 THEN 0 ELSE 40 + (c_custkey * 37) % 341 END AS DOUBLE) AS tst,
             15 + (c_custkey * 13) % 11 AS rem_pct,
             10 + (c_custkey * 7) % 11 AS deep_pct,
             CASE c_custkey % 4 WHEN 0 THEN '18-30' WHEN 1 THEN '31-50' WHEN 2 THEN '51-70' ELSE '71+' END AS age_group,
             CASE WHEN c_custkey % 7 < 4 THEN 'M' ELSE 'F' END AS sex
      FROM {customer}) b
"""

# As raw_sleep_studies, but with stages that exceed the night on some rows.
RAW_SLEEP_STUDIES_OVERFULL = """
SELECT study_id, study_date, total_sleep_time_min,
       CASE WHEN total_sleep_time_min % 5 = 0 THEN rem_min + 2.5 ELSE rem_min END AS rem_min,
       CASE WHEN total_sleep_time_min % 7 = 0 THEN deep_min + 1 ELSE deep_min END AS deep_min,
       light_min, age_group, sex
FROM ({raw_sleep_studies}) s
"""

# 'Apnea' and the NULL type must both normalise to 'other'.
RAW_EVENTS = """
SELECT concat('STUDY_', lpad(CAST(user_id AS STRING), 9, '0')) AS study_id,
       CASE event_type WHEN 'click' THEN 'apnea' WHEN 'view' THEN 'hypopnea'
                       WHEN 'purchase' THEN 'arousal' WHEN 'signup' THEN 'Apnea' END AS event_type,
       value AS duration_sec, ts AS study_datetime
FROM {events}
"""

# Text columns as in a landed file, with missing and unreadable values.
RAW_EVENTS_DIRTY = """
SELECT CASE WHEN event_id % 501 = 0 THEN NULL ELSE concat('STUDY_', lpad(CAST(user_id AS STRING), 9, '0')) END AS study_id,
       event_type,
       CASE WHEN event_id % 307 = 0 THEN 'n/a' WHEN event_id % 211 = 0 THEN '-1.5'
            WHEN event_id % 401 = 0 THEN NULL ELSE '0.5' END AS duration_sec,
       CASE WHEN event_id % 613 = 0 THEN 'not a time' ELSE '2024-01-01 22:00:00' END AS study_datetime
FROM {events}
"""

RAW_STUDIES_DIRTY = """
SELECT CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE concat('STUDY_', lpad(CAST(c_custkey AS STRING), 9, '0')) END AS study_id,
       CASE WHEN c_custkey % 103 = 0 THEN '2024-13-45' WHEN c_custkey % 107 = 0 THEN NULL ELSE '2024-01-01' END AS study_date,
       CASE WHEN c_custkey % 109 = 0 THEN 'unknown' ELSE '380.5' END AS total_sleep_time_min,
       CASE WHEN c_custkey % 113 = 0 THEN '7h' ELSE '80.1' END AS rem_min,
       '60.0' AS deep_min,
       CASE WHEN c_custkey % 127 = 0 THEN NULL ELSE '240.4' END AS light_min,
       '18-30' AS age_group, 'M' AS sex
FROM {customer}
"""

# The three null markers of the landing format, in text and number columns.
RAW_EVENTS_TOKENS = """
SELECT CASE event_id % 9 WHEN 0 THEN 'NULL' ELSE concat('STUDY_', lpad(CAST(user_id AS STRING), 9, '0')) END AS study_id,
       CASE event_id % 7 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE event_type END AS event_type,
       CASE event_id % 5 WHEN 0 THEN 'NULL' WHEN 1 THEN 'null' WHEN 2 THEN '' ELSE CAST(CAST(user_id AS INT) AS STRING) END AS duration_sec,
       CASE event_id % 11 WHEN 0 THEN 'NULL' ELSE '2024-01-01 22:00:00' END AS study_datetime
FROM {events}
"""

# Events without zero durations, which are missing here: these pass the rules at every scale.
RAW_EVENTS_MEASURED = """
SELECT study_id, event_type, nullif(duration_sec, 0) AS duration_sec, study_datetime FROM ({raw_events}) e
"""

# Text with line breaks, quotes and commas inside of fields.
RAW_EVENTS_BREAKS = """
SELECT CASE event_id % 4 WHEN 0 THEN concat('STUDY', chr(10), CAST(user_id AS STRING)) ELSE CAST(user_id AS STRING) END AS study_id,
       CASE event_id % 5 WHEN 0 THEN concat('say "', event_type, '",', chr(10), chr(10), 'then') WHEN 1 THEN concat(chr(10), event_type)
                         WHEN 2 THEN '","' ELSE event_type END AS event_type,
       CAST(user_id AS DOUBLE) AS duration_sec, ts AS study_datetime
FROM {events}
"""

# Studies that repeat their ids, on other and on equal days, and some without an id.
RAW_STUDIES_REPEATED = """
SELECT CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE concat('STUDY_', lpad(CAST(o_custkey AS STRING), 9, '0')) END AS study_id,
       DATE '2024-01-01' + CAST(o_orderkey % 5 AS INT) AS study_date,
       CAST(CASE WHEN o_orderkey % 41 = 0 THEN 0 ELSE 300 + o_orderkey % 3 END AS DOUBLE) AS total_sleep_time_min,
       CAST(60 + o_orderkey % 2 AS DOUBLE) AS rem_min, CAST(50 AS DOUBLE) AS deep_min, CAST(150 AS DOUBLE) AS light_min,
       CASE o_orderkey % 3 WHEN 0 THEN '18-30' WHEN 1 THEN '71+' END AS age_group,
       CASE WHEN o_orderkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex
FROM {orders}
"""

# Times with and without an offset, as text.
RAW_EVENTS_OFFSETS = """
SELECT concat('STUDY_', lpad(CAST(user_id AS STRING), 9, '0')) AS study_id, 'apnea' AS event_type, '1.5' AS duration_sec,
       CASE event_id % 4 WHEN 0 THEN '2024-01-01T23:30:00-05:00' WHEN 1 THEN '2024-01-01T23:30:00.000Z'
                         WHEN 2 THEN '2024-01-02 01:15:00+02:00' ELSE '2024-01-01 23:30:00' END AS study_datetime
FROM {events}
"""

# Nominal 128 Hz, so bin k of a 64-sample epoch lies at 2k Hz.
SIGNAL_EPOCHS = """
SELECT concat('PHYS_', lpad(CAST(vec_id % 5 AS STRING), 3, '0')) AS subject_id,
       vec_id AS epoch_id,
       CASE label % 6 WHEN 0 THEN 'Sleep stage W' WHEN 1 THEN 'Sleep stage R' WHEN 2 THEN 'Sleep stage 1'
                      WHEN 3 THEN 'Sleep stage 2' WHEN 4 THEN 'Sleep stage 3' ELSE 'Sleep stage 4' END AS sleep_stage,
       embedding AS samples
FROM {embeddings}
"""
# Epochs with the time they begin; one a day, so that both engines write it alike.
SIGNAL_EPOCHS_TIMED = """
SELECT e.*, CAST(DATE '2024-01-01' + CAST(epoch_id % 300 AS INT) AS TIMESTAMP) AS timestamp FROM ({signal_epochs}) e
"""
SIGNAL_RATE_HZ = 128.0

TEXTS = {
    "raw_sleep_studies": RAW_SLEEP_STUDIES,
    "raw_sleep_studies_overfull": RAW_SLEEP_STUDIES_OVERFULL,
    "raw_events": RAW_EVENTS,
    "raw_events_dirty": RAW_EVENTS_DIRTY,
    "raw_studies_dirty": RAW_STUDIES_DIRTY,
    "raw_events_tokens": RAW_EVENTS_TOKENS,
    "raw_events_measured": RAW_EVENTS_MEASURED,
    "raw_events_breaks": RAW_EVENTS_BREAKS,
    "raw_studies_repeated": RAW_STUDIES_REPEATED,
    "raw_events_offsets": RAW_EVENTS_OFFSETS,
    "signal_epochs": SIGNAL_EPOCHS,
    "signal_epochs_timed": SIGNAL_EPOCHS_TIMED,
}
# The columns used, declared so that no job has to look into a file for them.
BASE_TABLES = {
    "customer": "c_custkey long",
    "orders": "o_orderkey long, o_custkey long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


def _text(name: str) -> str:
    """A view's text, the views below it put in."""
    text = TEXTS[name]
    for below in ("raw_sleep_studies", "raw_events", "signal_epochs"):
        text = text.replace(f"{{{below}}}", TEXTS[below])
    return text


def sql_text(name: str) -> str:
    """A view's SQL over the bare table names."""
    return _text(name).format(**{t: t for t in BASE_TABLES})


def sample_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view over the Parquet tables of a folder."""
    text = _text(name)
    used = {
        table: spark.read.schema(columns).parquet(f"{folder}/{table}.parquet")
        for table, columns in BASE_TABLES.items()
        if f"{{{table}}}" in text
    }
    return spark.sql(text, **used)
