"""What the plans must look like to hold at scale."""

from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import DATA
from studymart.contracts import STUDY_SCHEMA
from studymart.operators import clinical, marts
from studymart.plans import models
from studymart.session import scratch_path

SIGNAL_QUERIES = {"band_power", "band_power_samples", "signal_analytics", "spectral_long", "spectral_share", "spectral_subject", "hypnogram"}
WRITING_QUERIES = {
    "scan_csv_roundtrip", "csv_null_tokens", "csv_rejects", "partition_read", "medallion_gold", "medallion_rejects", "ingest_once",
    "hypnogram", "hypnogram_subject", "hypnogram_timed", "scan_any", "load_tables", "models_run",
    "medallion_refreshed", "load_ledger", "csv_line_breaks", "signal_mart",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.CORPUS_QUERIES) - WRITING_QUERIES))
def test_no_python_rows_no_cross_joins_no_single_partition_windows(spark, name):
    text = plan(contract.queries()[name](spark, DATA))
    assert "BatchEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Window " not in text
    assert ("ArrowEvalPython" in text) == (name in SIGNAL_QUERIES)


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(contract.queries()["fct_event_rates"](spark, DATA))
    assert "props" not in text and "event_id" not in text
    assert "ReadSchema: struct<label:int>" not in text
    stage = plan(contract.queries()["cohort_values"](spark, DATA))
    assert "embedding#" not in stage.split("ReadSchema")[-1]


def test_stored_facts_push_cohort_filters_to_the_scan(spark):
    path = scratch_path(spark, "summary")
    summary = marts.fct_sleep_summary(
        spark.createDataFrame([("a", date(2024, 1, 1), 60.0, 1.0, 1.0, 1.0, "71+", "F")], STUDY_SCHEMA)
    )
    summary.write.parquet(path)
    rates = spark.createDataFrame(
        [("a", date(2024, 1, 1), 1, 1, 0, 0, 1.0)],
        "study_id string, event_date date, total_events long, apnea_count long, hypopnea_count long,"
        " arousal_count long, avg_event_duration_sec double",
    )
    cohort = clinical.cohort_filter(spark.read.parquet(path), "2024-01-01", "2024-01-31", ["F"], ["71+"])
    text = plan(clinical.clinical_joined(cohort, rates))
    pushed = text[text.index("PushedFilters") :].split("]")[0]
    for column in ("study_date", "sex", "age_group"):
        assert column in pushed


def test_aggregation_starts_before_the_shuffle(spark):
    text = plan(contract.queries()["fct_event_rates"](spark, DATA))
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_count")


def test_figures_never_move_rows_in_one_piece(spark, no_broadcast):
    text = plan(contract.queries()["severity_distribution"](spark, DATA))
    assert "SinglePartition" not in text


def test_checks_on_one_table_share_its_shuffle(spark):
    df = contract.queries()["check_unique"](spark, DATA)
    final = plan(df).partition("Initial Plan")[0]
    assert final.count("Expand") <= 3  # one for each table, however many keys are checked on it
    rates = models.unique_tests({"fct_event_rates": spark.read.parquet(f"{DATA}/events.parquet").selectExpr(
        "cast(user_id AS string) study_id", "to_date(ts) event_date")}, strict_rate_key=True)
    assert plan(rates).count("hashpartitioning") == 1


@pytest.mark.parametrize("nights, dates", [(9_900, 400), (20_000, 28)])
def test_a_study_that_multiplies_is_joined_in_parts(spark, no_broadcast, nights, dates):
    """One id in a third of the rows: no task makes most of its pairs, in either join."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        summary = spark.range(0, 3 * nights, 1, 4).selectExpr(
            "if(id % 3 = 0, 'hot', concat('s', id)) AS study_id", "date'2024-01-01' AS study_date",
            "-0.0D + if(id % 7 = 0, 0, id) AS total_sleep_time_min", "1.0D AS rem_percentage",
            "if(id % 2 = 0, -0.0D, 1.0D) AS deep_min", "1.0D AS light_min", "'71+' AS age_group", "'F' AS sex",
        )
        events = spark.range(0, dates).selectExpr(
            "explode(array('hot', concat('s', id))) AS study_id", "'apnea' AS event_type", "1.0D AS duration_sec",
            "date_add(date'2024-01-01', cast(id AS int)) AS event_date",
        )
        rates = marts.fct_event_rates(events)
        joined = clinical.clinical_joined(summary, rates)
        assert joined.count() == nights * dates + 2 * nights
        spread = joined.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert spread.max() < 0.3 * spread.sum()
        plain = summary.join(rates, "study_id", "left").selectExpr("xxhash64(study_id, total_sleep_time_min, deep_min, event_date) AS h")
        ours = clinical.split_left_join(summary, rates, "study_id", F.monotonically_increasing_id(), F.col("event_date"))
        digest = "bit_xor(h)", "count(*)"
        ours = ours.selectExpr("xxhash64(study_id, total_sleep_time_min, deep_min, event_date) AS h")
        assert ours.selectExpr(*digest).first() == plain.selectExpr(*digest).first()
        assert joined.where("cast(deep_min AS string) = '-0.0'").count() > nights
        cells = clinical.cohort_cells(summary, rates)
        assert cells.agg(F.sum("weight")).first()[0] == nights * dates + 2 * nights
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("part_rows", [4, 30, 1000])
def test_both_sides_of_a_heavy_key_are_cut(spark, part_rows):
    """Equal to the plain join for keys heavy on either side or both, missing, null, and with equal salts."""
    sizes = {"both": (40, 60), "left": (90, 2), "right": (1, 70), "light": (1, 1), "lonely": (9, 0), "other": (0, 5), None: (3, 4)}
    left = [(k, i) for k, (n, _) in sizes.items() for i in range(n)]
    right = [(k, i // 2) for k, (_, n) in sizes.items() for i in range(n)]
    left, right = spark.createDataFrame(left, "k string, a int"), spark.createDataFrame(right, "k string, b int")
    ours = clinical.split_left_join(left, right, "k", F.col("a"), F.col("b"), part_rows)
    plain = left.join(right, "k", "left")
    assert ours.columns == plain.columns
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_scratch_folder_is_the_shared_one(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
