"""A feature table that grows by new epochs only, and its means from states that merge.

Below a root lie ``features`` and ``states``, each with a folder ``load_id=...`` for every run that
found new epochs; a commit names the loads that count, so both grow together or not at all.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studymart.functions.spectrum import BAND_COLUMNS
from studymart.operators.signals import band_power
from studymart.sources.commits import CommitLog
from studymart.sources.ledger import LOAD

EPOCH_KEY = ["subject_id", "epoch_id"]
MEAN_KEY = ["subject_id", "sleep_stage"]


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root.rstrip('/')}/_log")


def _stored(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    loads = _log(spark, root).latest()[1].get("loads", [])
    base = f"{root.rstrip('/')}/{kind}"
    return spark.read.option("basePath", base).parquet(*[f"{base}/{LOAD}={n}" for n in loads]).drop(LOAD) if loads else None


def grow(spark: SparkSession, epochs: DataFrame, root: str, sample_rate: float) -> int:
    """Add the epochs (subject_id, epoch_id, sleep_stage, samples, ...) that aren't stored yet; returns their number.

    Spectra are computed for new epochs alone, once each. Epochs without a subject or id are left
    out; new epochs that repeat a key raise ValueError before anything is added.
    """
    log, known = _log(spark, root), _stored(spark, root, "features")
    version, state = log.latest()
    new = epochs.dropna(subset=EPOCH_KEY)
    if known is not None:
        new = new.join(known.select(*EPOCH_KEY), EPOCH_KEY, "left_anti")
    twice = new.groupBy(*EPOCH_KEY).count().where("count > 1").select(*EPOCH_KEY).limit(5).collect()
    if twice:
        raise ValueError("epochs that repeat: " + ", ".join(f"{r.subject_id}/{r.epoch_id}" for r in twice))
    load = uuid.uuid4().hex
    path = {kind: f"{root.rstrip('/')}/{kind}/{LOAD}={load}" for kind in ("features", "states")}
    band_power(new, sample_rate).write.parquet(path["features"])
    added = spark.read.parquet(path["features"])
    n = added.count()
    if not n:
        return 0
    # Sums and numbers of values, per load: merging them reads no feature again.
    sums = [F.sum(c).alias(f"{c}_sum") for c in BAND_COLUMNS]
    added.groupBy(*MEAN_KEY).agg(*sums, *[F.count(c).alias(f"{c}_n") for c in BAND_COLUMNS]).write.parquet(path["states"])
    log.commit(version + 1, {"loads": [*state.get("loads", []), load]})
    return n


def signal_features(spark: SparkSession, root: str) -> DataFrame:
    """All stored features."""
    found = _stored(spark, root, "features")
    if found is None:
        raise ValueError(f"{root} holds no features")
    return found


def signal_means(spark: SparkSession, root: str) -> DataFrame:
    """`signals.signal_analytics` of all stored features, merged from the states of the loads."""
    states = _stored(spark, root, "states")
    if states is None:
        raise ValueError(f"{root} holds no features")
    means = [(F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0).cast("long"))).alias(f"avg_{c}") for c in BAND_COLUMNS]
    return states.groupBy(*MEAN_KEY).agg(*means)
