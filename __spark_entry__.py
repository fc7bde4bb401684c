
import importlib.util
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studymart import contracts
from studymart.operators import clinical, declared, marts, quality, signals, staging
from studymart.plans import features, medallion, models
from studymart.session import materialise, scratch_path
from studymart.sources import files, tables
from studymart.sources.sample_views import SIGNAL_RATE_HZ, sample_view, sql_text
from studymart.streaming.ingest import ingest_once, loaded

CORPUS_QUERIES, CORPUS_SQL = {}, {}
# The corpus operators are an optional part; where it is there, it must import.
if importlib.util.find_spec("studymart.llm") and importlib.util.find_spec("corpus_pipeline"):
    import corpus_pipeline
    from studymart.llm.queries import ORACLES as CORPUS_SQL
    from studymart.llm.queries import QUERIES as CORPUS_QUERIES

    CORPUS_QUERIES = {**CORPUS_QUERIES, "pipeline": corpus_pipeline.run}

# Demonstration arguments of the queries that take any.
COHORT = {
    "start": "2024-01-05",
    "end": "2024-01-20",
    "sexes": ["M"],
    "age_groups": ["31-50", "51-70"],
}
PATIENT = "STUDY_000000007"
SUBJECT = "PHYS_003"
CALENDAR = ("2023-12-28", "2024-02-03")
DAYS = (date(2024, 1, 10), date(2024, 1, 19))


#: Doubles that queries pass on as they were read.
AS_READ = {"duration_sec", "total_sleep_time_min", "rem_min", "deep_min", "light_min"}


def rounded(df: DataFrame) -> DataFrame:
    """Computed doubles to six places; engines differ in the order they add up means."""
    return df.withColumns({c: F.round(c, 6) for c, kind in df.dtypes if kind == "double" and c not in AS_READ})


# --- Inputs -------------------------------------------------------------------


def _stg_events(spark, sf):
    return staging.stg_events(sample_view(spark, sf, "raw_events"))


def _stg_studies(spark, sf):
    return staging.stg_sleep_study(sample_view(spark, sf, "raw_sleep_studies"))


def _rates(spark, sf):
    return marts.fct_event_rates(_stg_events(spark, sf))


def _summary(spark, sf):
    return marts.fct_sleep_summary(_stg_studies(spark, sf))


def _joined(spark, sf):
    return clinical.clinical_joined(_summary(spark, sf), _rates(spark, sf))


def _repeated(spark, sf):
    """Studies whose ids repeat or are missing."""
    return marts.fct_sleep_summary(staging.stg_sleep_study(sample_view(spark, sf, "raw_studies_repeated")))


def _cells(spark, sf):
    return clinical.cohort_cells(_summary(spark, sf), _rates(spark, sf))


def _features(spark, sf):
    return signals.band_power(sample_view(spark, sf, "signal_epochs"), SIGNAL_RATE_HZ)


def _analytics(spark, sf):
    return signals.signal_analytics(_features(spark, sf))


def _tables(spark, sf):
    return {
        "stg_sleep_study": _stg_studies(spark, sf),
        "stg_events": _stg_events(spark, sf),
        "fct_sleep_summary": _summary(spark, sf),
        "fct_event_rates": _rates(spark, sf),
    }


# --- Queries that write and read back -----------------------------------------


def scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "landed_events")
    files.write_landing_csv(sample_view(spark, sf, "raw_events"), path)
    return files.scan_csv(spark, path, contracts.EVENT_SCHEMA)


def csv_null_tokens(spark, sf):
    path = scratch_path(spark, "landed_tokens")
    files.write_landing_csv(sample_view(spark, sf, "raw_events_tokens"), path)
    return files.scan_csv(spark, path, contracts.EVENT_SCHEMA)


def csv_rejects(spark, sf):
    """Unreadable values by column, from the reject lists of a typed scan."""
    path = scratch_path(spark, "landed_dirty")
    files.write_landing_csv(sample_view(spark, sf, "raw_events_dirty"), path)
    events = files.scan_csv(spark, path, contracts.EVENT_SCHEMA, rejects="rejected_fields")
    return (
        events.select(F.explode("rejected_fields").alias("column_name"))
        .groupBy("column_name")
        .agg(F.count("*").alias("rejected"))
    )


def partition_read(spark, sf):
    root = scratch_path(spark, "silver_events")
    silver = staging.bronze_to_silver(sample_view(spark, sf, "raw_events"))
    files.write_days(silver.withColumn(contracts.DAY, F.col("event_date")), root, rebalance=True)
    return files.read_days(spark, root, *DAYS)


def _landed_lake(spark, sf, name: str) -> str:
    """A lake whose raw events have landed by day."""
    base = scratch_path(spark, name)
    landed = sample_view(spark, sf, "raw_events_measured").withColumn(contracts.DAY, F.to_date("study_datetime"))
    files.write_landing_days(landed, medallion.folder(base, "raw"))
    return base


def medallion_gold(spark, sf):
    """Landed CSV by day through silver and the gate to gold, for all days in one pass."""
    base = _landed_lake(spark, sf, "lake")
    days = files.landed_days(spark, medallion.folder(base, "raw"), date.min, date.max)
    medallion.backfill(spark, base, days[0], days[-1], missing_ok=True)
    return medallion.published(spark, base, "gold")


def medallion_refreshed(spark, sf):
    """Gold after all days were built and then one late file landed, which alone is read anew."""
    base = _landed_lake(spark, sf, "late_lake")
    medallion.refresh(spark, base)
    late = sample_view(spark, sf, "raw_events_measured").where(F.to_date("study_datetime") == F.lit(DAYS[0]))
    files.write_landing_csv(late, f"{files.day_path(medallion.folder(base, 'raw'), DAYS[0])}/late")
    medallion.refresh(spark, base)
    return medallion.published(spark, base, "gold")


def medallion_rejects(spark, sf):
    """What the gate finds in a landed day with unreadable, missing and negative values."""
    base = scratch_path(spark, "dirty_lake")
    files.write_landing_csv(sample_view(spark, sf, "raw_events_dirty"), files.day_path(medallion.folder(base, "raw"), DAYS[0]))
    try:
        medallion.run_day(spark, base, DAYS[0])
        found = []
    except quality.QualityGateError as error:
        found = error.failures
    return spark.createDataFrame(found, contracts.REPORT_SCHEMA)


def time_offsets(spark, sf):
    """Times with offsets, moved to UTC, and their dates."""
    events = files.typed(sample_view(spark, sf, "raw_events_offsets"), contracts.EVENT_SCHEMA)
    return staging.bronze_to_silver(events).select("study_id", "study_datetime", "event_date")


def scan_any_rows(spark, sf):
    """A folder of CSV and one of Parquet, each recognised by its files."""
    events, path = sample_view(spark, sf, "raw_events"), scratch_path(spark, "any")
    files.write_landing_csv(events, f"{path}/csv")
    events.write.parquet(f"{path}/parquet")
    kinds = [files.scan_any(spark, f"{path}/{k}").withColumn("kind", F.lit(k)) for k in ("csv", "parquet")]
    return kinds[0].unionByName(kinds[1])


def _raw_database(spark, sf) -> str:
    """A database with the raw tables, loaded from landed files that are told apart by their paths."""
    database, path = f"raw_{uuid.uuid4().hex}", scratch_path(spark, "landing")
    tables.create_raw_tables(spark, database)
    for view in tables.RAW_TABLES:
        files.write_landing_csv(sample_view(spark, sf, view), f"{path}/{view}")
    for view, name in tables.RAW_TABLES.items():
        source = f"{path}/{view}"
        tables.load_csv(spark, source, f"{database}.{name}", tables.RAW_SCHEMAS[name], file_pattern=rf".*{view}/.*\.csv")
    return database


def load_tables(spark, sf):
    """The raw events as loaded into the catalog, by their source name."""
    database = _raw_database(spark, sf)
    out = materialise(tables.source(spark, "raw_events", database).select(*contracts.EVENT_SCHEMA.names), "loaded_events")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


def load_ledger(spark, sf):
    """Rows of a table after a first load, the same load again, and a load of one more file set."""
    database, path = f"raw_{uuid.uuid4().hex}", scratch_path(spark, "ledger_landing")
    name = f"{database}.events"
    tables.create_raw_tables(spark, database)
    totals = []
    for part in ("first", "first", "second"):
        if not files.path_exists(spark, f"{path}/{part}"):
            files.write_landing_csv(sample_view(spark, sf, "raw_events"), f"{path}/{part}")
        tables.load_csv(spark, path, name, contracts.EVENT_SCHEMA)
        totals.append(spark.table(name).count())
    loads = tables.loaded_files(spark, name).agg(F.countDistinct("load_id").alias("loads"))
    counts = [F.lit(n).cast("long").alias(f"rows_{i}") for i, n in enumerate(totals)]
    out = materialise(loads.select(*counts, "loads"), "ledger_totals")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


def csv_line_breaks(spark, sf):
    """Events whose fields hold line breaks, quotes and commas, read back record by record."""
    path = scratch_path(spark, "landed_breaks")
    files.write_landing_csv(sample_view(spark, sf, "raw_events_breaks"), path)
    return files.scan_csv(spark, path, contracts.EVENT_SCHEMA, line_breaks=True)


def rules_without_column(spark, sf):
    """The event rules over a table that has no duration: only those whose column is there."""
    return quality.rule_report(sample_view(spark, sf, "raw_events_dirty").drop("duration_sec"), quality.EVENT_RULES)


def models_run(spark, sf):
    """Test report of the marts, with the rows of each."""
    database, raw = f"marts_{uuid.uuid4().hex}", _raw_database(spark, sf)
    report = models.run(spark, raw, database)
    rows = [(f"{t}.rows", "", spark.table(f"{database}.{t}").count()) for t in models.MART_FACTS]
    for name in (raw, database):
        spark.sql(f"DROP DATABASE {name} CASCADE")
    return report.unionByName(spark.createDataFrame(rows, contracts.REPORT_SCHEMA))


def signal_mart(spark, sf):
    """The signal mart after its features grew in two runs, each computing only its new epochs."""
    root, epochs = scratch_path(spark, "signals"), sample_view(spark, sf, "signal_epochs")
    for known in (epochs.where("epoch_id % 3 = 0"), epochs):
        features.grow(spark, known, root, SIGNAL_RATE_HZ)
    return features.signal_means(spark, root)


def ingest_once_rows(spark, sf):
    """Rows loaded by a first run over landed files and by a second run over the same files."""
    base = scratch_path(spark, "ingest")
    source, target, checkpoint = (f"{base}/{n}" for n in ("landed", "events", "checkpoint"))
    files.write_landing_csv(sample_view(spark, sf, "raw_events"), source)
    totals = []
    for _ in range(2):
        ingest_once(spark, source, target, checkpoint, contracts.EVENT_SCHEMA, glob="*.csv")
        totals.append(loaded(spark, target, contracts.EVENT_SCHEMA).count())
    return loaded(spark, target, contracts.EVENT_SCHEMA).agg(
        F.lit(totals[0]).cast("long").alias("first_run_rows"),
        (F.count("*") - totals[0]).alias("second_run_rows"),
    )


def hypnogram(spark, sf, subject_id=None):
    features = _features(spark, sf).select("subject_id", "epoch_id", "sleep_stage", "delta_rel")
    return signals.hypnogram(materialise(features, "signal_features"), subject_id)


def hypnogram_timed(spark, sf):
    """The hypnogram with the time of each epoch."""
    epochs = sample_view(spark, sf, "signal_epochs_timed")
    epochs = epochs.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return signals.hypnogram(materialise(signals.band_power(epochs, SIGNAL_RATE_HZ), "timed_features"))


def band_power_samples(spark, sf):
    """Band power from single samples: some twice, in no order, and some epochs with gaps."""
    epochs = sample_view(spark, sf, "signal_epochs")
    per_epoch = 64
    long = epochs.select("subject_id", "epoch_id", F.posexplode("samples").alias("at", "x"))
    kind = F.col("epoch_id") % 7
    long = long.where(~((kind == 3) & (F.col("at") == 5)) & ~((kind == 5) & (F.col("at") >= 60)))
    long = long.select("subject_id", (F.col("epoch_id") * per_epoch + F.col("at")).alias("i"), "x")
    again = long.where(F.col("i") % 5 == 0)
    cut = signals.epochs_of_samples(long.unionByName(again), per_epoch)
    powers = signals.band_power(cut.drop("gaps", "conflicts"), SIGNAL_RATE_HZ)
    return powers.withColumn("missing", F.col("missing").cast("long"))


# --- Checks -------------------------------------------------------------------


def check_contract(spark, sf):
    return quality.combine(
        quality.rule_report(
            sample_view(spark, sf, "raw_studies_dirty"),
            quality.contract_rules(
                contracts.STUDY_SCHEMA, contracts.REQUIRED_STUDY_COLUMNS, "sleep_summary"
            ),
        ),
        quality.rule_report(
            sample_view(spark, sf, "raw_events_dirty"),
            quality.contract_rules(contracts.EVENT_SCHEMA, contracts.REQUIRED_EVENT_COLUMNS, "events"),
        ),
    )


#: Column tests as users declare them.
DECLARED_TESTS = {
    "models": [
        {"name": "stg_sleep_study", "columns": [{"name": "study_id", "tests": ["unique", "not_null"]}]},
        {
            "name": "stg_events",
            "columns": [
                {"name": "study_id", "tests": ["not_null"]},
                {"name": "event_type", "tests": [{"accepted_values": {"values": list(contracts.EVENT_TYPES)}}]},
            ],
        },
        {"name": "fct_sleep_summary", "columns": [{"name": "study_id", "tests": ["unique", "not_null"]}]},
        {"name": "fct_event_rates", "columns": [{"name": "study_id", "tests": ["unique", "not_null"]}]},
    ]
}


def check_declared(spark, sf):
    """The declared tests over the models: a scan for the rows and a shuffle for the keys of each table."""
    return declared.declared_report(_tables(spark, sf), declared.model_tests(DECLARED_TESTS))


def quality_report(spark, sf):
    events = files.typed(sample_view(spark, sf, "raw_events_dirty"), contracts.EVENT_SCHEMA)
    return quality.rule_report(events, quality.EVENT_RULES)


def check_accepted_values(spark, sf):
    raw = quality.accepted_values("event_type", contracts.EVENT_TYPES, "raw_events.accepted_values")
    return quality.combine(
        models.accepted_value_tests({"stg_events": _stg_events(spark, sf)}),
        quality.rule_report(sample_view(spark, sf, "raw_events"), [raw]),
    )


def check_stage_sum_overfull(spark, sf):
    studies = sample_view(spark, sf, "raw_sleep_studies_overfull")
    return quality.stage_sum_violations(marts.fct_sleep_summary(studies))


def cohort_values(spark, sf):
    subjects = clinical.distinct_values(sample_view(spark, sf, "signal_epochs"), ["subject_id"])
    studies = clinical.distinct_values(_summary(spark, sf), ["sex", "age_group", "study_id"])
    return studies.unionByName(subjects)


def filtered_overview(spark, sf):
    """The overview of a filtered cohort, as the pages show it."""
    cohort = clinical.cohort_filter(_summary(spark, sf), **COHORT)
    return clinical.cohort_overview(clinical.cohort_cells(cohort, _rates(spark, sf)))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_events": lambda s, d: _stg_events(s, d).drop("ingestion_time"),
    "stg_sleep_study": lambda s, d: _stg_studies(s, d).drop("ingestion_time"),
    "bronze_to_silver": lambda s, d: staging.bronze_to_silver(sample_view(s, d, "raw_events")),
    "fct_event_rates": _rates,
    "fct_sleep_summary": _summary,
    "dim_time": lambda s, d: marts.calendar_activity(marts.dim_time(s), _rates(s, d)),
    "tile_apnea_trend": lambda s, d: marts.tile_apnea_trend(_rates(s, d)),
    "tile_stage_distribution": lambda s, d: marts.tile_stage_distribution(_summary(s, d)),
    "clinical_joined": _joined,
    "clinical_by_study": lambda s, d: clinical.clinical_by_study(_summary(s, d), _rates(s, d)),
    "dataset_stats": lambda s, d: clinical.dataset_stats(_summary(s, d)),
    "cohort_values": cohort_values,
    "clinical_joined_repeated": lambda s, d: clinical.clinical_joined(_repeated(s, d), _rates(s, d)),
    "cohort_filter": lambda s, d: clinical.clinical_joined(
        clinical.cohort_filter(_summary(s, d), **COHORT), _rates(s, d)
    ),
    "cohort_overview": lambda s, d: clinical.cohort_overview(_cells(s, d)),
    "cohort_overview_display": lambda s, d: clinical.display(clinical.cohort_overview(_cells(s, d))),
    "cohort_overview_filtered": filtered_overview,
    "cohort_overview_by_study": lambda s, d: clinical.cohort_overview(
        clinical.unit_cells(clinical.clinical_by_study(_summary(s, d), _rates(s, d)))
    ),
    "sleep_architecture": lambda s, d: clinical.sleep_architecture(_cells(s, d)),
    "severity_distribution": lambda s, d: clinical.severity_distribution(_cells(s, d)),
    "severity_repeated": lambda s, d: clinical.severity_distribution(
        clinical.cohort_cells(_repeated(s, d), _rates(s, d))
    ),
    "ahi_by_age": lambda s, d: clinical.ahi_by_age(_cells(s, d)),
    "ahi_vs_duration": lambda s, d: clinical.ahi_vs_duration(_joined(s, d)),
    "patient_vs_cohort": lambda s, d: clinical.patient_vs_cohort(_summary(s, d), _rates(s, d), PATIENT),
    "patient_scorecards": lambda s, d: clinical.patient_scorecards(_summary(s, d), _rates(s, d)),
    "patient_details": lambda s, d: clinical.patient_details(_summary(s, d), _rates(s, d)),
    "patient_details_repeated": lambda s, d: clinical.patient_details(_repeated(s, d), _rates(s, d)),
    "quality_report": quality_report,
    "check_unique": lambda s, d: models.unique_tests(_tables(s, d), strict_rate_key=True),
    "check_keys_repeated": lambda s, d: quality.combine(
        models.unique_tests({"fct_sleep_summary": _repeated(s, d)}),
        models.not_null_tests({"fct_sleep_summary": _repeated(s, d)}),
    ),
    "check_not_null": lambda s, d: models.not_null_tests(_tables(s, d)),
    "check_accepted_values": check_accepted_values,
    "check_declared": check_declared,
    "unaccepted_values": lambda s, d: quality.unaccepted_values(
        sample_view(s, d, "raw_events"), "event_type", contracts.EVENT_TYPES
    ),
    "check_contract": check_contract,
    "check_stage_sum": lambda s, d: quality.stage_sum_violations(_summary(s, d)),
    "check_stage_sum_overfull": check_stage_sum_overfull,
    "scan_csv_roundtrip": scan_csv_roundtrip,
    "csv_null_tokens": csv_null_tokens,
    "csv_rejects": csv_rejects,
    "partition_read": partition_read,
    "scan_any": scan_any_rows,
    "load_tables": load_tables,
    "models_run": models_run,
    "time_offsets": time_offsets,
    "medallion_gold": medallion_gold,
    "medallion_refreshed": medallion_refreshed,
    "load_ledger": load_ledger,
    "csv_line_breaks": csv_line_breaks,
    "rules_without_column": rules_without_column,
    "medallion_rejects": medallion_rejects,
    "backfill_calendar": lambda s, d: medallion.backfill_calendar(_stg_events(s, d), *CALENDAR),
    "ingest_once": ingest_once_rows,
    "band_power": _features,
    "signal_mart": signal_mart,
    "signal_analytics": lambda s, d: _analytics(s, d),
    "spectral_long": lambda s, d: signals.spectral_long(_analytics(s, d)),
    "spectral_share": lambda s, d: signals.spectral_share(_analytics(s, d)),
    "band_power_samples": band_power_samples,
    "hypnogram": hypnogram,
    "hypnogram_subject": lambda s, d: hypnogram(s, d, SUBJECT),
    "hypnogram_timed": hypnogram_timed,
    "spectral_subject": lambda s, d: signals.spectral_share(
        _analytics(s, d).where(F.col("subject_id") == SUBJECT)
    ),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: studies per severity class."""
    return clinical.severity_distribution(_cells(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per implemented query; each takes (spark, folder of the tables)."""

    def finished(build):
        return lambda spark, sf_dir: rounded(build(spark, sf_dir))

    return {name: finished(build) for name, build in _QUERIES.items()} | CORPUS_QUERIES


# --- DuckDB counterparts --------------------------------------------------------

_MODEL_CTES = {
    "raw_sleep_studies": sql_text("raw_sleep_studies"),
    "raw_events": sql_text("raw_events"),
    "stg_events": """
        SELECT study_id, duration_sec, study_datetime,
               CASE WHEN event_type IN ('apnea', 'hypopnea', 'arousal') THEN event_type
                    ELSE 'other' END AS event_type,
               CAST(study_datetime AS DATE) AS event_date
        FROM raw_events""",
    "fct_event_rates": """
        SELECT study_id, event_date,
               count(*) AS total_events,
               count(*) FILTER (WHERE event_type = 'apnea') AS apnea_count,
               count(*) FILTER (WHERE event_type = 'hypopnea') AS hypopnea_count,
               count(*) FILTER (WHERE event_type = 'arousal') AS arousal_count,
               avg(duration_sec) AS avg_event_duration_sec
        FROM stg_events GROUP BY study_id, event_date""",
    "fct_sleep_summary": """
        SELECT *, rem_min / nullif(total_sleep_time_min, 0) * 100 AS rem_percentage
        FROM raw_sleep_studies""",
    "joined_counts": """
        SELECT s.study_id, s.study_date, s.total_sleep_time_min, s.rem_percentage, s.deep_min,
               s.light_min, s.age_group, s.sex, r.event_date,
               coalesce(r.total_events, 0) AS total_events,
               coalesce(r.apnea_count, 0) AS apnea_count,
               coalesce(r.hypopnea_count, 0) AS hypopnea_count,
               coalesce(r.arousal_count, 0) AS arousal_count,
               r.avg_event_duration_sec
        FROM fct_sleep_summary s LEFT JOIN fct_event_rates r ON s.study_id = r.study_id""",
    "joined_index": """
        SELECT *, (apnea_count + hypopnea_count) / nullif(total_sleep_time_min / 60, 0) AS ahi
        FROM joined_counts""",
    "joined": """
        SELECT *, CASE WHEN ahi < 5 THEN 'Normal' WHEN ahi < 15 THEN 'Mild'
                       WHEN ahi < 30 THEN 'Moderate' ELSE 'Severe' END AS ahi_severity
        FROM joined_index""",
    "study_counts": """
        SELECT s.study_id, s.study_date, s.total_sleep_time_min, s.rem_percentage, s.deep_min,
               s.light_min, s.age_group, s.sex,
               coalesce(e.total_events, 0) AS total_events,
               coalesce(e.apnea_count, 0) AS apnea_count,
               coalesce(e.hypopnea_count, 0) AS hypopnea_count,
               coalesce(e.arousal_count, 0) AS arousal_count,
               (coalesce(e.apnea_count, 0) + coalesce(e.hypopnea_count, 0))
                   / nullif(s.total_sleep_time_min / 60, 0) AS ahi
        FROM fct_sleep_summary s
        LEFT JOIN (SELECT study_id, count(*) AS total_events,
                          count(*) FILTER (WHERE event_type = 'apnea') AS apnea_count,
                          count(*) FILTER (WHERE event_type = 'hypopnea') AS hypopnea_count,
                          count(*) FILTER (WHERE event_type = 'arousal') AS arousal_count
                   FROM stg_events GROUP BY study_id) e ON s.study_id = e.study_id""",
    "by_study": """
        SELECT *, CASE WHEN ahi < 5 THEN 'Normal' WHEN ahi < 15 THEN 'Mild'
                       WHEN ahi < 30 THEN 'Moderate' ELSE 'Severe' END AS ahi_severity
        FROM study_counts""",
    "first_rows": """
        SELECT * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY study_id
                ORDER BY study_date NULLS FIRST, total_sleep_time_min NULLS FIRST,
                         rem_percentage NULLS FIRST, deep_min NULLS FIRST, event_date NULLS FIRST
            ) AS position FROM joined) WHERE position = 1""",
    "cohort_means": """
        SELECT avg(ahi) AS ahi, avg(rem_percentage) AS rem, avg(deep_min) AS deep FROM joined""",
}

# A plain Fourier sum per bin, in place of the FFT.
_SIGNAL_CTES = {
    "epochs": sql_text("signal_epochs"),
    "samples_long": """
        SELECT epoch_id, len(samples) AS n, unnest(samples) AS x,
               unnest(range(0, len(samples))) AS i
        FROM epochs""",
    "spectrum": """
        SELECT epoch_id, k, n,
               power(sum(x::DOUBLE * cos(2 * pi() * k * i / n)), 2)
               + power(sum(x::DOUBLE * sin(2 * pi() * k * i / n)), 2) AS p
        FROM (SELECT *, unnest(range(1, n // 2 + 1)) AS k FROM samples_long)
        GROUP BY epoch_id, k, n""",
    "bins": "SELECT epoch_id, k * 128.0 / n AS hz, p FROM spectrum",
    "bands": """
        SELECT epoch_id, sum(p) FILTER (WHERE hz >= 0.5) AS total,
               sum(p) FILTER (WHERE hz >= 0.5 AND hz < 4) AS delta,
               sum(p) FILTER (WHERE hz >= 4 AND hz < 8) AS theta,
               sum(p) FILTER (WHERE hz >= 8 AND hz < 12) AS alpha,
               sum(p) FILTER (WHERE hz >= 12 AND hz < 30) AS beta,
               sum(p) FILTER (WHERE hz >= 30) AS gamma
        FROM bins GROUP BY epoch_id""",
    "features": """
        SELECT e.subject_id, e.epoch_id, e.sleep_stage,
               b.delta / nullif(b.total, 0) AS delta_rel, b.theta / nullif(b.total, 0) AS theta_rel,
               b.alpha / nullif(b.total, 0) AS alpha_rel, b.beta / nullif(b.total, 0) AS beta_rel,
               b.gamma / nullif(b.total, 0) AS gamma_rel
        FROM epochs e LEFT JOIN bands b ON e.epoch_id = b.epoch_id""",
    "analytics": """
        SELECT subject_id, sleep_stage, avg(delta_rel) AS avg_delta_rel, avg(theta_rel) AS avg_theta_rel,
               avg(alpha_rel) AS avg_alpha_rel, avg(beta_rel) AS avg_beta_rel, avg(gamma_rel) AS avg_gamma_rel
        FROM features GROUP BY subject_id, sleep_stage""",
    "analytics_long": """
        SELECT subject_id, sleep_stage, 'delta' AS band, avg_delta_rel AS relative_power FROM analytics
        UNION ALL SELECT subject_id, sleep_stage, 'theta', avg_theta_rel FROM analytics
        UNION ALL SELECT subject_id, sleep_stage, 'alpha', avg_alpha_rel FROM analytics
        UNION ALL SELECT subject_id, sleep_stage, 'beta', avg_beta_rel FROM analytics
        UNION ALL SELECT subject_id, sleep_stage, 'gamma', avg_gamma_rel FROM analytics""",
}

_JOINED_COLUMNS = """study_id, study_date, total_sleep_time_min, round(rem_percentage, 6) AS rem_percentage,
    deep_min, light_min, age_group, sex, total_events, apnea_count, hypopnea_count, arousal_count"""
_OVERVIEW = """SELECT count(*) AS total_studies, round(avg(ahi), 6) AS avg_ahi,
    round(coalesce(100.0 * count(*) FILTER (WHERE ahi_severity = 'Severe') / nullif(count(*), 0), 0), 6) AS severe_pct,
    round(avg(total_sleep_time_min) / 60, 6) AS avg_sleep_hours FROM """
_SILVER = """SELECT study_id, event_type, duration_sec, study_datetime,
    CASE WHEN event_type IN ('apnea', 'hypopnea', 'arousal') THEN event_type ELSE 'other' END AS event_type_norm,
    CAST(study_datetime AS DATE) AS event_date"""
_COHORT_WHERE = """ WHERE study_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
    AND sex IN ('M') AND age_group IN ('31-50', '51-70')"""


def _over(ctes: dict[str, str], select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes.items()) + "\n" + select


def _report(view: str, lines: list[tuple[str, str, str]]) -> str:
    """One report line per (rule, column, broken condition) over one view."""
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{column}' AS column_name, count(*) FILTER (WHERE {broken}) AS violations"
        f" FROM ({view})"
        for rule, column, broken in lines
    )


def _unique(table: str, keys: str, present: str) -> str:
    return (
        f"SELECT '{table}.unique' AS rule, '{keys}' AS column_name, count(*) AS violations FROM"
        f" (SELECT {keys} FROM {table} WHERE {present} GROUP BY {keys} HAVING count(*) > 1)"
    )


def _scorecard(keys: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}'{metric}' AS metric, round(p.{patient}, 6) AS patient, round(c.{mean}, 6) AS cohort_avg"
        " FROM patients p, cohort_means c"
        for metric, patient, mean in (
            ("AHI", "ahi", "ahi"),
            ("REM %", "rem_percentage", "rem"),
            ("Deep Sleep (min)", "deep_min", "deep"),
        )
    )


def _model_sql() -> dict[str, str]:
    rates = """study_id, event_date, total_events, apnea_count, hypopnea_count, arousal_count,
        round(avg_event_duration_sec, 6) AS avg_event_duration_sec"""
    index = "round(ahi, 6) AS ahi, ahi_severity"
    joined = f"SELECT {_JOINED_COLUMNS}, round(avg_event_duration_sec, 6) AS avg_event_duration_sec, {index} FROM joined"
    study_columns = """study_id, study_date, total_sleep_time_min, rem_min, deep_min, light_min, age_group, sex,
        round(rem_percentage, 6) AS rem_percentage"""
    one = {**_MODEL_CTES, "patients": f"SELECT * FROM first_rows WHERE study_id = '{PATIENT}'"}
    every = {**_MODEL_CTES, "patients": "SELECT * FROM first_rows"}
    plain = {
        "stg_events": "SELECT study_id, duration_sec, study_datetime, event_type, event_date FROM stg_events",
        "stg_sleep_study": "SELECT * FROM raw_sleep_studies",
        "bronze_to_silver": f"SELECT * FROM ({_SILVER} FROM raw_events)",
        "fct_event_rates": f"SELECT {rates} FROM fct_event_rates",
        "fct_sleep_summary": f"SELECT {study_columns} FROM fct_sleep_summary",
        "dim_time": """
            SELECT d AS date_actual, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
                   CAST(quarter(d) AS INT) AS quarter, total_events
            FROM (SELECT coalesce(d, event_date) AS d, coalesce(n, 0) AS total_events
                  FROM (SELECT DATE '2020-01-01' + CAST(i AS INT) AS d FROM range(3660) t(i))
                  FULL JOIN (SELECT event_date, count(*) AS n FROM stg_events GROUP BY event_date) e ON d = event_date)""",
        "tile_apnea_trend": """
            SELECT CAST(date_trunc('month', event_date) AS DATE) AS month,
                   round(avg(apnea_count + hypopnea_count), 6) AS avg_ahi
            FROM fct_event_rates GROUP BY 1 ORDER BY 1""",
        "tile_stage_distribution": """
            SELECT age_group, round(avg(rem_min), 6) AS avg_rem, round(avg(deep_min), 6) AS avg_deep,
                   round(avg(light_min), 6) AS avg_light
            FROM fct_sleep_summary GROUP BY age_group""",
        "clinical_joined": joined,
        "cohort_filter": joined + _COHORT_WHERE,
        "clinical_by_study": f"SELECT {_JOINED_COLUMNS}, {index} FROM by_study",
        "dataset_stats": """
            SELECT count(DISTINCT study_id) AS unique_patients, min(study_date) AS start_date,
                   max(study_date) AS end_date FROM joined""",
        "cohort_values": f"""
            SELECT DISTINCT 'sex' AS dimension, sex AS value FROM joined
            UNION ALL SELECT DISTINCT 'age_group', age_group FROM joined
            UNION ALL SELECT DISTINCT 'study_id', study_id FROM joined
            UNION ALL SELECT DISTINCT 'subject_id', subject_id FROM ({sql_text("signal_epochs")})""",
        "cohort_overview": _OVERVIEW + "joined",
        "cohort_overview_display": f"""
            SELECT total_studies, round(avg_ahi, 1) AS avg_ahi, round(severe_pct, 1) AS severe_pct,
                   round(avg_sleep_hours, 1) AS avg_sleep_hours FROM ({_OVERVIEW} joined)""",
        "cohort_overview_filtered": _OVERVIEW + "joined" + _COHORT_WHERE,
        "cohort_overview_by_study": _OVERVIEW + "by_study",
        "sleep_architecture": """
            SELECT stage, round(percentage, 6) AS percentage FROM (
                SELECT 'REM' AS stage, avg(rem_percentage) AS percentage, avg(total_sleep_time_min) AS t FROM joined
                UNION ALL SELECT 'Deep', avg(deep_min) / avg(total_sleep_time_min) * 100, avg(total_sleep_time_min) FROM joined
                UNION ALL SELECT 'Light', avg(light_min) / avg(total_sleep_time_min) * 100, avg(total_sleep_time_min) FROM joined
            ) WHERE t > 0""",
        "severity_distribution": "SELECT ahi_severity, count(*) AS studies FROM joined GROUP BY ahi_severity",
        "ahi_by_age": "SELECT age_group, round(avg(ahi), 6) AS avg_ahi FROM joined WHERE age_group IS NOT NULL GROUP BY age_group",
        "ahi_vs_duration": "SELECT total_sleep_time_min, round(ahi, 6) AS ahi, age_group, arousal_count FROM joined",
        "patient_details": f"""
            SELECT study_id, {index}, total_events, arousal_count,
                   round(total_sleep_time_min / 60, 6) AS sleep_hours FROM first_rows""",
        "check_unique": " UNION ALL ".join(
            [
                _unique("stg_sleep_study", "study_id", "study_id IS NOT NULL").replace(
                    "FROM stg_sleep_study", "FROM raw_sleep_studies"
                ),
                _unique("fct_sleep_summary", "study_id", "study_id IS NOT NULL"),
                _unique("fct_event_rates", "study_id, event_date", "study_id IS NOT NULL AND event_date IS NOT NULL"),
                _unique("fct_event_rates", "study_id", "study_id IS NOT NULL"),
            ]
        ),
        "check_not_null": " UNION ALL ".join(
            f"SELECT '{name}.not_null' AS rule, 'study_id' AS column_name,"
            f" count(*) FILTER (WHERE study_id IS NULL) AS violations FROM {table}"
            for name, table in (
                ("stg_sleep_study", "raw_sleep_studies"),
                ("stg_events", "stg_events"),
                ("fct_sleep_summary", "fct_sleep_summary"),
                ("fct_event_rates", "fct_event_rates"),
            )
        ),
        "check_accepted_values": " UNION ALL ".join(
            f"SELECT '{t}.accepted_values' AS rule, 'event_type' AS column_name, count(*) FILTER"
            f" (WHERE event_type NOT IN ('apnea', 'hypopnea', 'arousal', 'other')) AS violations FROM {t}"
            for t in ("stg_events", "raw_events")
        ),
        "unaccepted_values": """
            SELECT event_type AS value, count(*) AS records FROM raw_events
            WHERE event_type NOT IN ('apnea', 'hypopnea', 'arousal', 'other') GROUP BY event_type""",
        "check_stage_sum": f"""
            SELECT {study_columns} FROM fct_sleep_summary
            WHERE total_sleep_time_min < rem_min + deep_min + light_min - 1""",
        "scan_csv_roundtrip": "SELECT study_id, event_type, duration_sec, study_datetime FROM raw_events",
        "load_tables": "SELECT study_id, event_type, duration_sec, study_datetime FROM raw_events",
        "scan_any": """
            SELECT study_id, event_type, duration_sec, study_datetime, kind
            FROM raw_events, (VALUES ('csv'), ('parquet')) k(kind)""",
        "partition_read": f"""
            SELECT *, event_date AS dt FROM ({_SILVER} FROM raw_events)
            WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'""",
        "load_ledger": """
            SELECT count(*) AS rows_0, count(*) AS rows_1, 2 * count(*) AS rows_2, CAST(2 AS BIGINT) AS loads FROM raw_events""",
        "backfill_calendar": """
            SELECT dt, coalesce(n, 0) AS event_rows
            FROM (SELECT DATE '2023-12-28' + CAST(i AS INT) AS dt
                  FROM range(date_diff('day', DATE '2023-12-28', DATE '2024-02-03') + 1) t(i))
            LEFT JOIN (SELECT event_date, count(*) AS n FROM stg_events GROUP BY event_date) e ON dt = event_date""",
        "ingest_once": "SELECT count(*) AS first_run_rows, CAST(0 AS BIGINT) AS second_run_rows FROM raw_events",
    }
    texts = {name: _over(_MODEL_CTES, select) for name, select in plain.items()}
    measured = {**_MODEL_CTES, "raw_events": sql_text("raw_events_measured")}
    texts["medallion_gold"] = _over(measured, f"SELECT {rates}, event_date AS dt FROM fct_event_rates")
    texts["medallion_refreshed"] = _over(
        measured,
        f"""SELECT study_id, event_date, total_events * n AS total_events, apnea_count * n AS apnea_count,
                   hypopnea_count * n AS hypopnea_count, arousal_count * n AS arousal_count,
                   round(avg_event_duration_sec, 6) AS avg_event_duration_sec, event_date AS dt
            FROM (SELECT *, CASE event_date WHEN DATE '{DAYS[0]}' THEN 2 ELSE 1 END AS n FROM fct_event_rates)""",
    )
    again = {**_MODEL_CTES, "raw_sleep_studies": sql_text("raw_studies_repeated")}
    for name, base in (
        ("clinical_joined_repeated", "clinical_joined"),
        ("severity_repeated", "severity_distribution"),
        ("patient_details_repeated", "patient_details"),
    ):
        texts[name] = _over(again, plain[base])
    texts["check_keys_repeated"] = _over(
        again,
        _unique("fct_sleep_summary", "study_id", "study_id IS NOT NULL")
        + """ UNION ALL SELECT 'fct_sleep_summary.not_null', 'study_id', count(*) FILTER (WHERE study_id IS NULL)
              FROM fct_sleep_summary""",
    )
    checks = [("stg_sleep_study.unique", "study_id"), ("stg_sleep_study.not_null", "study_id"), ("stg_events.not_null", "study_id")]
    checks += [("stg_events.accepted_values", "event_type"), ("fct_sleep_summary.unique", "study_id")]
    checks += [("fct_event_rates.unique", "study_id, event_date"), ("fct_sleep_summary.not_null", "study_id")]
    checks += [("fct_sleep_summary.stage_sum", "total_sleep_time_min"), ("fct_event_rates.not_null", "study_id")]
    texts["models_run"] = _over(
        _MODEL_CTES,
        " UNION ALL ".join(f"SELECT '{r}' AS rule, '{c}' AS column_name, CAST(0 AS BIGINT) AS violations" for r, c in checks)
        + " UNION ALL SELECT 'fct_sleep_summary.rows', '', count(*) FROM fct_sleep_summary"
        + " UNION ALL SELECT 'fct_event_rates.rows', '', count(*) FROM fct_event_rates",
    )
    accepted = plain["check_accepted_values"].partition(" UNION ALL ")[0]
    declared_keys = [k for k in plain["check_unique"].split(" UNION ALL ") if "study_id, event_date" not in k]
    texts["check_declared"] = _over(_MODEL_CTES, " UNION ALL ".join([*declared_keys, plain["check_not_null"], accepted]))
    texts["patient_vs_cohort"] = _over(one, _scorecard(""))
    texts["patient_scorecards"] = _over(every, _scorecard("p.study_id, "))
    return texts


def _signal_sql() -> dict[str, str]:
    bands = ", ".join(f"round({b}_rel, 6) AS {b}_rel" for b, _, _ in contracts.BANDS)
    means = ", ".join(f"round(avg_{b}_rel, 6) AS avg_{b}_rel" for b, _, _ in contracts.BANDS)
    plain = {
        "band_power": f"SELECT subject_id, epoch_id, sleep_stage, {bands} FROM features",
        "signal_analytics": f"SELECT subject_id, sleep_stage, {means} FROM analytics",
        "spectral_long": "SELECT subject_id, sleep_stage, band, round(relative_power, 6) AS relative_power FROM analytics_long",
        "spectral_share": """
            SELECT subject_id, sleep_stage, band, round(relative_power, 6) AS relative_power,
                   round(relative_power / sum(relative_power) OVER (PARTITION BY subject_id, sleep_stage), 6) AS share
            FROM analytics_long""",
        "hypnogram": """
            SELECT subject_id, epoch_id, sleep_stage,
                   CASE sleep_stage WHEN 'Sleep stage W' THEN 1 WHEN 'Sleep stage R' THEN 2
                        WHEN 'Sleep stage 1' THEN 3 WHEN 'Sleep stage 2' THEN 4
                        WHEN 'Sleep stage 3' THEN 5 WHEN 'Sleep stage 4' THEN 6 END AS stage_rank,
                   round(delta_rel, 6) AS delta_rel
            FROM features ORDER BY subject_id, epoch_id""",
    }
    told = ", ".join(f"CASE missing WHEN 0 THEN round({b}_rel, 6) END AS {b}_rel" for b, _, _ in contracts.BANDS)
    plain["band_power_samples"] = f"""
        SELECT f.subject_id, f.epoch_id, missing, {told}
        FROM features f JOIN (
            SELECT epoch_id, CAST(CASE epoch_id % 7 WHEN 3 THEN 1 WHEN 5 THEN len(samples) - 60 ELSE 0 END AS BIGINT) AS missing
            FROM epochs) g ON f.epoch_id = g.epoch_id"""
    plain["signal_mart"] = plain["signal_analytics"]
    plain["hypnogram_subject"] = f"SELECT * FROM ({plain['hypnogram']}) WHERE subject_id = '{SUBJECT}'"
    plain["hypnogram_timed"] = f"""
        SELECT h.*, t.timestamp FROM ({plain["hypnogram"]}) h JOIN ({sql_text("signal_epochs_timed")}) t
        ON h.epoch_id = t.epoch_id"""
    plain["spectral_subject"] = f"SELECT * FROM ({plain['spectral_share']}) WHERE subject_id = '{SUBJECT}'"
    return {name: _over(_SIGNAL_CTES, select) for name, select in plain.items()}


def _check_sql() -> dict[str, str]:
    events, studies = sql_text("raw_events_dirty"), sql_text("raw_studies_dirty")
    untyped = "{0} IS NOT NULL AND TRY_CAST({0} AS {1}) IS NULL"
    numbers = ("total_sleep_time_min", "rem_min", "deep_min", "light_min")
    study_lines = [
        ("sleep_summary.required", "study_id", "study_id IS NULL"),
        ("sleep_summary.required", "study_date", "study_date IS NULL"),
        ("sleep_summary.date", "study_date", untyped.format("study_date", "DATE")),
        *[("sleep_summary.number", c, untyped.format(c, "DOUBLE")) for c in numbers],
    ]
    event_lines = [
        ("events.required", "study_id", "study_id IS NULL"),
        ("events.required", "event_type", "event_type IS NULL"),
        ("events.number", "duration_sec", untyped.format("duration_sec", "DOUBLE")),
        ("events.timestamp_ntz", "study_datetime", untyped.format("study_datetime", "TIMESTAMP")),
    ]
    token = "CASE WHEN {0} IN ('NULL', 'null', '') THEN NULL ELSE {0} END"
    overfull = sql_text("raw_sleep_studies_overfull")
    return {
        "check_contract": _report(studies, study_lines) + " UNION ALL " + _report(events, event_lines),
        "quality_report": _report(
            events,
            [
                ("not_null", "study_id", "study_id IS NULL"),
                ("positive", "duration_sec", "TRY_CAST(duration_sec AS DOUBLE) <= 0"),
            ],
        ),
        "csv_line_breaks": sql_text("raw_events_breaks"),
        "rules_without_column": _report(events, [("not_null", "study_id", "study_id IS NULL")]),
        "csv_rejects": f"""
            SELECT column_name, rejected FROM (
                SELECT 'duration_sec' AS column_name,
                       count(*) FILTER (WHERE {untyped.format("duration_sec", "DOUBLE")}) AS rejected FROM ({events})
                UNION ALL
                SELECT 'study_datetime',
                       count(*) FILTER (WHERE {untyped.format("study_datetime", "TIMESTAMP")}) FROM ({events})
            ) WHERE rejected > 0""",
        "csv_null_tokens": f"""
            SELECT {token.format("study_id")} AS study_id, {token.format("event_type")} AS event_type,
                   TRY_CAST({token.format("duration_sec")} AS DOUBLE) AS duration_sec,
                   TRY_CAST({token.format("study_datetime")} AS TIMESTAMP) AS study_datetime
            FROM ({sql_text("raw_events_tokens")})""",
        "medallion_rejects": f"""
            SELECT * FROM ({
            _report(
                events,
                [
                    ("not_null", "study_id", "study_id IS NULL"),
                    ("positive", "duration_sec", "TRY_CAST(duration_sec AS DOUBLE) <= 0"),
                    (
                        "readable",
                        contracts.REJECTS,
                        untyped.format("duration_sec", "DOUBLE")
                        + " OR "
                        + untyped.format("study_datetime", "TIMESTAMP"),
                    ),
                ],
            )
        }) WHERE violations > 0""",
        "time_offsets": f"""
            SELECT study_id, t AS study_datetime, CAST(t AS DATE) AS event_date
            FROM (SELECT study_id, CASE study_datetime
                      WHEN '2024-01-01T23:30:00-05:00' THEN TIMESTAMP '2024-01-02 04:30:00'
                      WHEN '2024-01-02 01:15:00+02:00' THEN TIMESTAMP '2024-01-01 23:15:00'
                      ELSE TIMESTAMP '2024-01-01 23:30:00' END AS t FROM ({sql_text("raw_events_offsets")}))""",
        "check_stage_sum_overfull": f"""
            SELECT *, round(rem_min / nullif(total_sleep_time_min, 0) * 100, 6) AS rem_percentage FROM ({overfull})
            WHERE total_sleep_time_min < rem_min + deep_min + light_min - 1""",
    }


def oracle_sql() -> dict[str, str]:
    """For each registered query the SQL that DuckDB runs on the same tables."""
    return {**_model_sql(), **_signal_sql(), **_check_sql(), **CORPUS_SQL}
