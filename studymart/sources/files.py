"""Typed scans of landed files, and day-partitioned reads and writes."""

import re
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studymart.contracts import DAY, EVENT_SCHEMA, NULL_TOKENS, landing_columns
from studymart.functions import null_if_token, try_read
from studymart.sources import records

CORRUPT = "_corrupt_record"
DAY_FOLDER = re.compile(DAY + r"=(\d{4}-\d{2}-\d{2})")
LANDED_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


class MissingInput(FileNotFoundError):
    """A path to read does not exist."""


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = _hadoop_path(spark, path)
    return files.exists(target)


def _formats(spark: SparkSession, path: str) -> set[str]:
    """Which of parquet and csv lie below a path; hidden files and folders don't count."""
    target, files = _hadoop_path(spark, path)
    if not files.exists(target):
        raise MissingInput(path)
    root, found, kinds = files.makeQualified(target).toString(), files.listFiles(target, True), set()
    while found.hasNext() and len(kinds) < 2:
        below = found.next().getPath().toString().removeprefix(root).strip("/").split("/")
        if not any(part.startswith(("_", ".")) for part in below):
            kinds.add("parquet" if ".parquet" in (below[-1] or root) else "csv")
    return kinds


def landed_days(spark: SparkSession, root: str, start: date, end: date) -> list[date]:
    """Days of an inclusive range that have a folder under ``root``, from one listing."""
    target, files = _hadoop_path(spark, root)
    if not files.exists(target):
        return []
    names = [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]
    days = [date.fromisoformat(m[1]) for n in names if (m := DAY_FOLDER.fullmatch(n))]
    return sorted(d for d in days if start <= d <= end)


def undated(spark: SparkSession, root: str) -> str | None:
    """The folder of rows without a day, if it landed."""
    path = f"{root.rstrip('/')}/{DAY}=__HIVE_DEFAULT_PARTITION__"
    return path if path_exists(spark, path) else None


def day_path(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/{DAY}={day.isoformat()}"


def typed(
    raw: DataFrame,
    schema: T.StructType,
    null_tokens: Iterable[str] = NULL_TOKENS,
    rejects: str | None = None,
) -> DataFrame:
    """Text columns, found by name, as the schema's types.

    A value that does not read as its type becomes NULL. With ``rejects`` the row also gets
    an array column of that name, listing the columns this happened to, so that no bad
    value vanishes unseen. Columns beyond the schema, the day among them, are kept.
    """
    tokens = tuple(null_tokens)
    types = {f.name: f.dataType for f in schema.fields}
    extra = [c for c in raw.columns if c not in types and c != CORRUPT]
    texts = {
        c: null_if_token((F.col(c) if c in raw.columns else F.lit(None)).cast("string"), tokens)
        for c in types
    }
    columns: list[Column] = [try_read(texts[c], t).alias(c) for c, t in types.items()]
    if rejects:
        flags = [
            F.when(texts[c].isNotNull() & try_read(texts[c], t).isNull(), F.lit(c))
            for c, t in types.items()
            if not isinstance(t, T.StringType)
        ]
        if CORRUPT in raw.columns:
            flags.append(F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT)))
        columns.append(F.array_compact(F.array(*flags)).alias(rejects))
    return raw.select(*columns, *extra)


def _header(reader: DataFrameReader, paths: list[str], chosen: Column | None) -> list[str]:
    """Column names in the first file, or in one of the chosen files."""
    if chosen is not None:
        found = reader.text(paths).where(chosen).select("_metadata.file_path").first()
        if found is None:
            raise MissingInput("no file matches in " + ", ".join(paths))
        paths = [found.file_path]
    return [c for c in reader.csv(paths).columns if c != DAY]


def scan_csv_text(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: Sequence[str] | None = None,
    glob: str | None = None,
    file_pattern: str | None = None,
    base_path: str | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """CSV with a header line, every column as text, malformed lines kept in a side column.

    Columns go by the names in the header, never by position: the header is read from the
    files unless given, and a file whose header differs fails the scan. ``glob`` chooses
    files by name, ``file_pattern`` by a regular expression on their paths. With ``line_breaks``
    quoted fields may hold them (see `studymart.sources.records`); without, a line is a record.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("header", True).option("escape", '"')
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if base_path:
        reader = reader.option("basePath", base_path)
    chosen = F.col("_metadata.file_path").rlike(file_pattern) if file_pattern else None
    try:
        names = list(header) if header else _header(reader, paths, chosen)
        if line_breaks and (broken := records.split_records(spark, paths, names, glob, file_pattern, base_path)):
            return records.parsed(broken, names, CORRUPT)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
        # Pruning would hide missing or surplus fields from the malformed-line check.
        text = (
            reader.schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("enforceSchema", False)
            .option("columnPruning", False)
            .csv(paths)
        )
        # A condition on file metadata drops files when the scan is planned.
        return text if chosen is None else text.where(chosen)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingInput(", ".join(paths)) from error
        raise


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    null_tokens: Iterable[str] = NULL_TOKENS,
    rejects: str | None = None,
    missing_ok: bool = False,
    **options,
) -> DataFrame:
    """Typed CSV scan; ``options`` are those of `scan_csv_text`.

    A missing path raises `MissingInput`, or gives no rows with ``missing_ok``.
    """
    try:
        text = scan_csv_text(spark, paths, **options)
    except MissingInput:
        if not missing_ok:
            raise
        return spark.createDataFrame([], schema)
    return typed(text, schema, null_tokens, rejects)


def scan_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    missing_ok: bool = False,
    base_path: str | None = None,
) -> DataFrame:
    """Parquet scan with the same treatment of a missing path as `scan_csv`."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if missing_ok and schema is not None:
            return spark.createDataFrame([], schema)
        raise MissingInput(", ".join(paths)) from error


def scan_any(
    spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, rejects: str | None = None
) -> DataFrame:
    """Parquet or CSV, told apart by the files found; a folder with both fails.

    CSV is typed, columns it lacks are left out; ``rejects`` is as in `typed` and empty for Parquet.
    """
    kinds = _formats(spark, path)
    if not kinds:
        raise MissingInput(path)
    if len(kinds) > 1:
        raise ValueError(f"{path} holds both Parquet and CSV")
    if kinds == {"parquet"}:
        stored = spark.read.parquet(path)
        return stored.withColumn(rejects, F.array().cast("array<string>")) if rejects else stored
    text = scan_csv_text(spark, path)
    present = T.StructType([f for f in schema.fields if f.name in text.columns])
    return typed(text, present, rejects=rejects)


def read_days(
    spark: SparkSession,
    root: str,
    start: date,
    end: date,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Stored days of an inclusive range with their day column; other folders are not listed."""
    days = landed_days(spark, root, start, end)
    if not days:
        raise MissingInput(f"{root} has no day from {start} to {end}")
    return scan_parquet(spark, [day_path(root, d) for d in days], schema, base_path=root)


def write_days(df: DataFrame, root: str, rebalance: bool = False) -> None:
    """Replace exactly the days the frame holds; other days stay.

    ``rebalance`` gathers each day's rows before writing and is for frames whose tasks hold
    many days. Adaptive execution then cuts a large day into several files and packs small
    ones together, so a day with a third of all rows is not written by one task.
    """
    if rebalance:
        df = df.hint("rebalance", F.col(DAY))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(root)
    )


def _landing_writer(df: DataFrame) -> DataFrameWriter:
    return (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)  # else the writer trims texts
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", LANDED_TIME_FORMAT)
    )


def write_landing_csv(df: DataFrame, path: str) -> None:
    """Overwrite a folder with CSV files as they land: header line, alphabetical columns."""
    _landing_writer(df.select(*landing_columns(df.schema))).csv(path)


def write_landing_days(df: DataFrame, root: str) -> None:
    """`write_landing_csv` into one folder per day, replacing the days the frame holds."""
    columns = [c for c in landing_columns(df.schema) if c != DAY]
    days = df.select(*columns, DAY).hint("rebalance", F.col(DAY))
    _landing_writer(days).option("partitionOverwriteMode", "dynamic").partitionBy(DAY).csv(root)
