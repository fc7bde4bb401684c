"""Spectral features of signal epochs and the figures derived from them."""

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studymart.contracts import BANDS
from studymart.functions import band_label, stage_rank, zero_if_null
from studymart.functions.spectrum import BAND_COLUMNS, band_power_udf

AVERAGE_COLUMNS = [f"avg_{name}_rel" for name, _, _ in BANDS]


def epochs_of_samples(samples: DataFrame, per_epoch: int) -> DataFrame:
    """Epochs from single samples (subject_id, i, x), in any order; sample ``i`` counts from 0 along a night.

    One row per subject and epoch of which any sample is there: ``samples`` in order, or NULL where
    some are missing (a NULL value counts as missing), how many are, and where: ``gaps`` are
    (first, last) positions. A sample that is there several times counts once; if the values differ
    the smallest counts, and ``conflicts`` tells how many samples that happened to. Samples without a
    subject or place belong to no epoch.

    Repeats are folded within each task before the first shuffle; after it an epoch has a value for
    each of its positions at most, so what is gathered for one row is bounded by ``per_epoch``,
    however long a night is.
    """
    placed = samples.where(F.col("subject_id").isNotNull() & (F.col("i") >= 0) & F.col("x").isNotNull())
    epoch = F.expr(f"i div {int(per_epoch)}").alias("epoch_id")
    position = (F.col("i") % per_epoch).cast("int").alias("position")
    once = placed.groupBy("subject_id", epoch, position).agg(
        F.min("x").cast("double").alias("x"), (F.min("x") != F.max("x")).cast("int").alias("conflict")
    )
    gathered = once.groupBy("subject_id", "epoch_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "x"))).alias("found"), F.sum("conflict").alias("conflicts")
    )
    # Between each found position and the next, and at both ends.
    before = F.concat(F.array(F.lit(-1)), F.col("found.position"))
    after = F.concat(F.col("found.position"), F.array(F.lit(int(per_epoch))))
    gaps = F.zip_with(before, after, lambda b, a: F.struct((b + 1).alias("first"), (a - 1).alias("last")))
    missing = (F.lit(per_epoch) - F.size("found")).alias("missing")
    return gathered.select(
        "subject_id",
        "epoch_id",
        F.when(F.size("found") == per_epoch, F.col("found.x")).alias("samples"),
        missing,
        F.filter(gaps, lambda g: g["first"] <= g["last"]).alias("gaps"),
        "conflicts",
    )


def band_power(epochs: DataFrame, sample_rate: float, samples: str = "samples") -> DataFrame:
    """Relative power per frequency band of every epoch; all other columns are kept.

    A map over epochs: no shuffle, and only the sample column crosses to Python. NULL where
    the samples are missing, incomplete or flat.
    """
    others = [c for c in epochs.columns if c != samples]
    powers = band_power_udf(sample_rate)(F.col(samples))
    return epochs.select(*others, powers.alias("powers")).select(
        *others, *[F.col(f"powers.{c}").alias(c) for c in BAND_COLUMNS]
    )


def signal_analytics(features: DataFrame) -> DataFrame:
    """Mean relative power of every band by subject and sleep stage."""
    return features.groupBy("subject_id", "sleep_stage").agg(
        *[F.avg(c).alias(f"avg_{c}") for c in BAND_COLUMNS]
    )


def spectral_long(analytics: DataFrame) -> DataFrame:
    """One row per subject, stage and band."""
    keys = ["subject_id", "sleep_stage"]
    melted = analytics.unpivot(keys, AVERAGE_COLUMNS, "column", "relative_power")
    return melted.select(*keys, band_label(F.col("column")).alias("band"), "relative_power")


def spectral_share(analytics: DataFrame) -> DataFrame:
    """`spectral_long` with every band's share of its stage total.

    ``analytics`` has one row per subject and stage with all bands side by side, so the
    total is taken along the row, before melting; no window, hence no second shuffle.
    """
    total = reduce(add, [zero_if_null(F.col(c)) for c in AVERAGE_COLUMNS])
    bands = F.array(
        *[
            F.struct(
                band_label(F.lit(c)).alias("band"),
                F.col(c).alias("relative_power"),
                (F.col(c) / F.nullif(total, F.lit(0.0))).alias("share"),
            )
            for c in AVERAGE_COLUMNS
        ]
    )
    return analytics.select("subject_id", "sleep_stage", F.inline(bands))


def hypnogram(features: DataFrame, subject_id: str | None = None) -> DataFrame:
    """Stages and delta power along the night, in epoch order; all subjects unless one is named.

    Give it a stored feature table (see `studymart.session.materialise`): sorting samples its
    input first, which would compute spectra twice.
    """
    if subject_id is not None:
        features = features.where(F.col("subject_id") == F.lit(subject_id))
    times = ["timestamp"] if "timestamp" in features.columns else []
    return features.select(
        "subject_id",
        "epoch_id",
        "sleep_stage",
        stage_rank(F.col("sleep_stage")).alias("stage_rank"),
        "delta_rel",
        *times,
    ).orderBy("subject_id", "epoch_id")
