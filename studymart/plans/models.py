"""Raw tables -> staging views -> mart tables -> checks."""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from studymart.contracts import EVENT_TYPES
from studymart.operators import quality
from studymart.operators.clinical import clinical_joined
from studymart.operators.marts import dim_time, fct_event_rates, fct_sleep_summary
from studymart.operators.staging import stg_events, stg_sleep_study
from studymart.plans import features
from studymart.sources.commits import CommitLog
from studymart.sources.tables import source

STAGING_VIEWS = ("stg_sleep_study", "stg_events")
MART_FACTS = ("fct_sleep_summary", "fct_event_rates")
MARTS = (*MART_FACTS, "dim_time")
SIGNAL_MART = "fct_signal_analytics"


def register_staging(spark: SparkSession, raw_database: str) -> None:
    """Staging models are views: nothing is computed until a mart reads them."""
    stg_sleep_study(source(spark, "raw_sleep_studies", raw_database)).createOrReplaceTempView(
        "stg_sleep_study"
    )
    stg_events(source(spark, "raw_events", raw_database)).createOrReplaceTempView("stg_events")


def _save(df: DataFrame, table: str, buckets: int | None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        # One sorted file per bucket: the clinical join then needs neither shuffle nor sort.
        writer = (
            df.repartition(buckets, "study_id")
            .write.mode("overwrite")
            .format("parquet")
            .bucketBy(buckets, "study_id")
            .sortBy("study_id")
        )
    writer.saveAsTable(table)


def build_marts(spark: SparkSession, database: str, buckets: int | None = None, suffix: str = "") -> None:
    """Mart models are tables, rebuilt whole from the staging views; ``suffix`` goes to their names.

    With ``buckets`` both facts are bucketed by study, which pays when they are joined often.
    It relies on the tested keys, one summary row per study and one rate row per study and
    date, which keep the buckets even. Without, adaptive execution plans each join.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    _save(fct_sleep_summary(spark.table("stg_sleep_study")), f"{database}.fct_sleep_summary{suffix}", buckets)
    _save(fct_event_rates(spark.table("stg_events")), f"{database}.fct_event_rates{suffix}", buckets)
    _save(dim_time(spark), f"{database}.dim_time{suffix}", None)


def clinical(spark: SparkSession, database: str) -> DataFrame:
    """The clinical frame over the mart tables; their tested keys leave no heavy study."""
    version = published(spark, database)
    facts = (mart(spark, database, name, version) for name in MART_FACTS)
    return clinical_joined(*facts, unique_ids=True)


def unique_tests(tables: dict[str, DataFrame], strict_rate_key: bool = False) -> DataFrame:
    """Key uniqueness of the given tables.

    The declared key of the rates is ``study_id`` alone, which a night over midnight breaks;
    the test is on their real key (study_id, event_date). ``strict_rate_key`` adds the
    declared one.
    """
    keys = [
        ("stg_sleep_study", ["study_id"]),
        ("fct_sleep_summary", ["study_id"]),
        ("fct_event_rates", ["study_id", "event_date"]),
    ]
    if strict_rate_key:
        keys.append(("fct_event_rates", ["study_id"]))
    by_table = {name: [(f"{name}.unique", columns) for n, columns in keys if n == name] for name in tables}
    return quality.combine(*[quality.unique_reports(tables[name], rules) for name, rules in by_table.items() if rules])


def not_null_tests(tables: dict[str, DataFrame]) -> DataFrame:
    return quality.combine(
        *[
            quality.rule_report(df, [quality.not_null("study_id", f"{name}.not_null")])
            for name, df in tables.items()
        ]
    )


def accepted_value_tests(tables: dict[str, DataFrame]) -> DataFrame:
    rule = quality.accepted_values("event_type", EVENT_TYPES, "stg_events.accepted_values")
    return quality.rule_report(tables["stg_events"], [rule])


def staging_tests(spark: SparkSession) -> DataFrame:
    """Keys, and all row rules of a view in one scan of it."""
    tables = {name: spark.table(name) for name in STAGING_VIEWS}
    present = {name: quality.not_null("study_id", f"{name}.not_null") for name in STAGING_VIEWS}
    types = quality.accepted_values("event_type", EVENT_TYPES, "stg_events.accepted_values")
    return quality.combine(
        unique_tests(tables),
        quality.rule_report(tables["stg_sleep_study"], [present["stg_sleep_study"]]),
        quality.rule_report(tables["stg_events"], [present["stg_events"], types]),
    )


def mart_tests(spark: SparkSession, database: str, suffix: str = "") -> DataFrame:
    """Keys, presence, and stages that add up to no more than the night."""
    tables = {name: spark.table(f"{database}.{name}{suffix}") for name in MART_FACTS}
    present = {name: quality.not_null("study_id", f"{name}.not_null") for name in MART_FACTS}
    return quality.combine(
        unique_tests(tables),
        quality.rule_report(tables["fct_sleep_summary"], [present["fct_sleep_summary"], quality.stage_sum()]),
        quality.rule_report(tables["fct_event_rates"], [present["fct_event_rates"]]),
    )


def _log(spark: SparkSession, database: str) -> CommitLog:
    for row in spark.sql(f"DESCRIBE DATABASE {database}").collect():
        if row.info_name == "Location":
            return CommitLog(spark, f"{row.info_value}/_published")
    raise ValueError(f"{database} has no location")


def published(spark: SparkSession, database: str) -> dict[str, str]:
    """The tables that the marts are at present, by name of the mart; all of one run."""
    return _log(spark, database).latest()[1].get("marts", {})


def mart(spark: SparkSession, database: str, name: str, version: dict[str, str] | None = None) -> DataFrame:
    """A mart as last published, or of a version that `published` gave, so that several fit together."""
    tables = published(spark, database) if version is None else version
    return spark.table(f"{database}.{tables[name]}")


def _point_views(spark: SparkSession, database: str) -> None:
    """The plain names are views of the published tables; they follow it one after the other."""
    for name, table in published(spark, database).items():
        if spark.catalog.tableExists(f"{database}.{name}") and spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
            spark.sql(f"ALTER TABLE {database}.{name} RENAME TO {database}.{name}__unversioned")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {database}.{table}")


def publish(spark: SparkSession, database: str, suffix: str, names: Sequence[str] = MARTS) -> None:
    """Make the tables built with ``suffix`` the marts: one commit switches all of them.

    Who reads through `mart` or `clinical` sees all old or all new tables at every step. The views are
    then moved; a run that dies before leaves them on the old tables, which stay until `vacuum`.
    """
    log = _log(spark, database)
    version, state = log.latest()
    new = {name: f"{name}{suffix}" for name in names}
    log.commit(version + 1, {"marts": {**state.get("marts", {}), **new}})
    _point_views(spark, database)


def vacuum(spark: SparkSession, database: str, keep: int = 2) -> None:
    """Drop tables of runs that failed or that none of the last ``keep`` commits names; not while a run goes on."""
    _point_views(spark, database)
    log = _log(spark, database)
    used = {t for v in log.versions()[-keep:] for t in log.read(v)["marts"].values()}
    for row in spark.catalog.listTables(database):
        if row.name.partition("__")[0] in (*MARTS, SIGNAL_MART) and "__" in row.name and row.name not in used:
            spark.sql(f"DROP TABLE {database}.{row.name}")


def _features_root(spark: SparkSession, database: str) -> str:
    return f"{_log(spark, database).folder.rpartition('/')[0]}/_signals"


def build_signals(spark: SparkSession, database: str, epochs: DataFrame, sample_rate: float, suffix: str) -> int:
    """Grow the stored features by new epochs and build their mart; returns how many spectra were computed.

    The features are the staging view ``stg_signal_features``.
    """
    root = _features_root(spark, database)
    n = features.grow(spark, epochs, root, sample_rate)
    features.signal_features(spark, root).createOrReplaceTempView("stg_signal_features")
    _save(features.signal_means(spark, root), f"{database}.{SIGNAL_MART}{suffix}", None)
    return n


def run(
    spark: SparkSession,
    raw_database: str,
    database: str,
    buckets: int | None = None,
    epochs: DataFrame | None = None,
    sample_rate: float | None = None,
) -> DataFrame:
    """Build everything from the raw tables and return the report of all model tests.

    With signal ``epochs`` the feature table grows by those it lacks, and its mart is published too.

    The staging views are tested first. The marts are built as tables of their own, tested, and only
    then published together; a failed test or a killed run leaves the old ones.
    """
    register_staging(spark, raw_database)
    staging = quality.require(staging_tests(spark))
    suffix = f"__{uuid.uuid4().hex}"
    build_marts(spark, database, buckets, suffix)
    names = MARTS
    if epochs is not None:
        build_signals(spark, database, epochs, sample_rate, suffix)
        names = (*MARTS, SIGNAL_MART)
    marts = quality.require(mart_tests(spark, database, suffix))
    publish(spark, database, suffix, names)
    return quality.combine(staging, marts)
