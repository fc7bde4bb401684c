"""Loading each landed file exactly once."""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studymart.contracts import NULL_TOKENS, as_text, landing_columns
from studymart.sources.files import CORRUPT, typed
from studymart.sources.ledger import LOAD, ChangedInput, Ledger


def ingest_once(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    glob: str | None = None,
    files_per_batch: int | None = None,
    purge: bool = False,
    rejects: str | None = None,
) -> None:
    """Load the CSV files under ``source`` that the target hasn't loaded, then stop.

    The checkpoint remembers the files of its stream, the target's ledger those of all: another
    stream, or a new checkpoint, adds only what no other has loaded. Rows are staged and committed
    together with their files, under a load named by stream and batch, so that a batch that is run
    again after a failure adds nothing. A file that changed after it was loaded stops the load with
    `ChangedInput`. ``files_per_batch`` bounds a batch when the backlog is long; ``purge``
    deletes source files once their batch is done. Files must carry the landing header.
    With ``rejects`` every row lists its unreadable columns, as in `typed`.
    """
    text = as_text(T.StructType([schema[c] for c in landing_columns(schema)]))
    if rejects:
        text = text.add(CORRUPT, T.StringType())
    reader = spark.readStream.schema(text).option("header", True).option("escape", '"')
    reader = reader.option("enforceSchema", False).option("columnPruning", False)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if purge:
        reader = reader.option("cleanSource", "delete")

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]
        load, ledger = f"{stream}-{batch_id}", Ledger(spark, target, apart=True)
        commits = ledger.commits()
        if not commits.where(F.col(LOAD) == load).isEmpty():
            return
        read = F.struct(
            F.col("file.file_path").alias("path"),
            F.col("file.file_size").alias("length"),
            F.col("file.file_modification_time").alias("changed_at"),
        )
        batch = batch.withColumn("file", read)
        if not commits.where(F.col("source") != stream).isEmpty():
            # Others have loaded into the target: look which files are left.
            fresh = ledger.unloaded(batch.select("file.*").distinct())
            told = [r.path for r in fresh.where("changed").orderBy("path").limit(20).collect()]
            if told:
                raise ChangedInput(told)
            batch = batch.join(fresh.select("path"), F.col("file.path") == F.col("path"), "left_semi")
        # The files are kept beside each row, so that one pass over the text gives both.
        rows = typed(batch, schema, NULL_TOKENS, rejects)
        rows.write.mode("overwrite").parquet(ledger.staged(load))
        files = spark.read.parquet(ledger.staged(load)).select("file.*").distinct()
        ledger.commit(load, files, stream)

    query = (
        reader.csv(source)
        .select("*", F.col("_metadata").alias("file"))
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def loaded(
    spark: SparkSession, target: str, schema: T.StructType, rejects: str | None = None
) -> DataFrame:
    """The rows loaded so far; none before the first load."""
    if rejects:
        schema = T.StructType([*schema.fields, T.StructField(rejects, T.ArrayType(T.StringType()))])
    try:
        return spark.read.schema(schema).option("basePath", target).parquet(f"{target}/{LOAD}=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
