"""Arrow kernel for relative band power, the one step Spark has no built-in for."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studymart.contracts import BANDS

BAND_COLUMNS = [f"{name}_rel" for name, _, _ in BANDS]
BAND_STRUCT = T.StructType([T.StructField(c, T.DoubleType()) for c in BAND_COLUMNS])

# Samples transformed at a time; bounds the memory of one task, not the result.
CHUNK_SAMPLES = 4_000_000


def band_membership(n_samples: int, sample_rate: float) -> np.ndarray:
    """1.0 where a spectral bin (row) lies in a band (column)."""
    hz = np.fft.rfftfreq(n_samples, d=1.0 / sample_rate)
    return np.stack(
        [(hz >= low) & (hz < (np.inf if high is None else high)) for _, low, high in BANDS], axis=1
    ).astype(np.float64)


def relative_power(signals: np.ndarray, sample_rate: float) -> np.ndarray:
    """Share of each band in the power of all bands, for a matrix of one signal per row.

    Rows with no power in any band, or with a missing sample, come out as NaN.
    """
    spectrum = np.fft.rfft(signals, axis=1)
    power = (spectrum.real**2 + spectrum.imag**2) @ band_membership(signals.shape[1], sample_rate)
    total = power.sum(axis=1, keepdims=True)
    return np.divide(power, total, out=np.full_like(power, np.nan), where=total > 0)


def _row_chunks(rows: np.ndarray, length: int) -> Iterator[np.ndarray]:
    step = max(1, CHUNK_SAMPLES // max(1, length))
    for start in range(0, len(rows), step):
        yield rows[start : start + step]


def band_power_udf(sample_rate: float):
    """UDF: array of samples -> struct of five relative band powers."""

    @F.arrow_udf(BAND_STRUCT)
    def band_powers(samples: pa.Array) -> pa.Array:
        lists = samples.combine_chunks() if isinstance(samples, pa.ChunkedArray) else samples
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False)
        lengths = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
        shares = np.full((len(lists), len(BAND_COLUMNS)), np.nan)
        for length in np.unique(lengths[lengths > 1]):
            for rows in _row_chunks(np.flatnonzero(lengths == length), int(length)):
                signals = values[offsets[rows][:, None] + np.arange(length)]
                shares[rows] = relative_power(signals.astype(np.float64), sample_rate)
        columns = [
            pa.array(shares[:, i], mask=~np.isfinite(shares[:, i])) for i in range(shares.shape[1])
        ]
        return pa.StructArray.from_arrays(columns, names=BAND_COLUMNS)

    return band_powers
