"""Raw tables in the catalog: creation and bulk load."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studymart.contracts import EVENT_SCHEMA, EVENT_SILVER_SCHEMA, REJECTS, STUDY_SCHEMA, with_decimals
from studymart.sources.commits import remove
from studymart.sources.files import CORRUPT, MissingInput, scan_csv
from studymart.sources.ledger import FILE_SCHEMA, Ledger, batches, list_files, new_load

# Logical source name -> table name in the raw database.
RAW_TABLES = {"raw_sleep_studies": "sleep_studies", "raw_events": "events"}
RAW_SCHEMAS = {"sleep_studies": STUDY_SCHEMA, "events": EVENT_SCHEMA}
SILVER_TABLE = "events_silver"
# Files that one commit of a long backlog takes.
FILES_PER_LOAD = 10_000


class UnreadableInput(ValueError):
    """Files hold values that don't read as their type; carries their number by column."""

    def __init__(self, table: str, counts: dict[str, int]):
        self.counts = counts
        super().__init__(f"not loaded into {table}: " + ", ".join(f"{c}: {n}" for c, n in counts.items()))


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, ingestion_time: bool = False
) -> None:
    """Create a Parquet table unless it exists, optionally with a defaulted load time."""
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields]
    if ingestion_time:
        columns.append("ingestion_time timestamp_ntz DEFAULT localtimestamp()")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet")


def create_raw_tables(
    spark: SparkSession, database: str, ingestion_time: bool = False, decimals: bool = False
) -> None:
    """The raw study and event tables and the silver table, in a database made if absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in {**RAW_SCHEMAS, SILVER_TABLE: EVENT_SILVER_SCHEMA}.items():
        shape = with_decimals(schema) if decimals else schema
        create_table(spark, f"{database}.{name}", shape, ingestion_time)


def table_location(spark: SparkSession, table: str) -> str:
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row.col_name == "Location":
            return row.data_type
    raise ValueError(f"{table} has no location")


def _defaults(spark: SparkSession, table: str, given: Sequence[str]) -> list[Column]:
    """All columns of a table in order: those given by name, the others by their defaults."""
    columns = []
    for field in spark.table(table).schema.fields:
        default = F.expr(field.metadata.get("CURRENT_DEFAULT", "NULL"))
        value = F.col(field.name) if field.name in given else default
        columns.append(value.cast(field.dataType).alias(field.name))
    return columns


def load_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: str,
    schema: T.StructType,
    file_pattern: str | None = None,
    unreadable_ok: bool = False,
    changed: str = "raise",
    force: bool = False,
    files_per_load: int = FILES_PER_LOAD,
) -> int:
    """Load the CSV files that the table hasn't loaded yet, columns by header name; returns their number.

    The table's ledger knows each file by path, length and time of change, and is committed together
    with the rows: a rerun, also after a failure, adds nothing twice. A loaded file that has changed
    since raises `ChangedInput`, or is left out (``changed="skip"``) or loaded beside its old rows
    (``"append"``). ``force`` loads all files again. Table columns the files lack take their
    defaults. Quoted fields may hold line breaks. Unreadable values and malformed lines stop the load
    before anything is added, with a count by column; ``unreadable_ok`` lets them in as NULL. Rows
    are checked and written in the same pass, staged; a backlog goes in loads of ``files_per_load``.
    """
    ledger = Ledger(spark, table_location(spark, table))
    found = list_files(spark, paths, pattern=file_pattern)
    fresh = found.withColumn("changed", F.lit(False)) if force else ledger.unloaded(found)
    loads, n = batches(fresh, files_per_load, changed), 0
    if not loads and found.isEmpty():
        raise MissingInput(f"no file to load into {table}")
    for batch in loads:
        load = new_load()
        rows = scan_csv(spark, [r.path for r in batch], schema, rejects=REJECTS, line_breaks=True)
        seen = Observation(load)
        bad = [F.count_if(F.array_contains(REJECTS, c)).alias(c) for c in (*schema.names, CORRUPT)]
        rows = rows.observe(seen, *bad).select(*_defaults(spark, table, schema.names))
        rows.write.mode("overwrite").parquet(ledger.staged(load))
        counts = {c: k for c, k in sorted(seen.get.items()) if k}
        if counts and not unreadable_ok:
            remove(spark, ledger.staged(load))
            raise UnreadableInput(table, counts)
        ledger.commit(load, spark.createDataFrame(batch, FILE_SCHEMA), "load_csv")
        n += len(batch)
    spark.catalog.refreshTable(table)
    return n


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """(path, length, changed_at, load_id) of the files that a table has loaded."""
    return Ledger(spark, table_location(spark, table)).files()


def source(spark: SparkSession, name: str, database: str) -> DataFrame:
    """A raw table by its logical name."""
    return spark.table(f"{database}.{RAW_TABLES[name]}")
