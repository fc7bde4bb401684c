"""From raw documents to training sequences: five stages, each over all that the one before kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studymart.llm import decontamination, packing, quality, simhash, suffix
from studymart.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.good_documents(docs, _table(spark, sf_dir, "labels")).select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return simhash.without_duplicates(docs).select(COLUMNS)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that start earlier; a document that loses all its text stays, empty.

    Characters that a cut splits are dropped. ``n_chars`` counts what is left.
    """
    return suffix.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_items(docs, _table(spark, sf_dir, "benchmark")).select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, by sequence; the ids themselves as a digest."""
    pieces = packing.pack(docs, added=packing.added_tokens())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeat_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: No stage but the decontamination can be put in SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; every stage is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
