import cmath

import numpy as np
import pytest

from studymart.contracts import BANDS, EPOCH_SCHEMA
from studymart.functions import spectrum
from studymart.operators import signals
from studymart.session import materialise


def shares_by_direct_sum(samples, rate):
    n = len(samples)
    power = {name: 0.0 for name, _, _ in BANDS}
    for k in range(n // 2 + 1):
        hz = k * rate / n
        bin_power = abs(sum(x * cmath.exp(-2j * cmath.pi * k * i / n) for i, x in enumerate(samples))) ** 2
        for name, low, high in BANDS:
            if hz >= low and (high is None or hz < high):
                power[name] += bin_power
    total = sum(power.values())
    return [p / total for p in power.values()]


@pytest.fixture
def epochs(frame):
    def build(*sample_lists):
        rows = [("s", i, "Sleep stage W", samples) for i, samples in enumerate(sample_lists)]
        return frame(rows, EPOCH_SCHEMA)

    return build


def powers(df):
    columns = [f"{name}_rel" for name, _, _ in BANDS]
    return [tuple(r[c] for c in columns) for r in df.orderBy("epoch_id").collect()]


@pytest.mark.parametrize("rate", [64.0, 100.0, 128.0])
def test_shares_equal_a_direct_fourier_sum(epochs, rate):
    rng = np.random.default_rng(7)
    lists = [rng.normal(size=n).tolist() for n in (16, 33, 64, 64, 100, 255)]
    got = powers(signals.band_power(epochs(*lists), rate))
    for samples, row in zip(lists, got):
        assert row == pytest.approx(shares_by_direct_sum(samples, rate), abs=1e-9)
        assert sum(row) == pytest.approx(1.0)


@pytest.mark.parametrize("hz, band", [(2, 0), (4, 1), (7, 1), (8, 2), (12, 3), (29, 3), (30, 4), (49, 4)])
def test_pure_tone_falls_into_its_band(epochs, hz, band):
    t = np.arange(3000) / 100.0
    row = powers(signals.band_power(epochs(np.sin(2 * np.pi * hz * t).tolist()), 100.0))[0]
    assert row[band] == pytest.approx(1.0, abs=1e-6)


def test_unusable_epochs_are_null(epochs):
    good = np.sin(np.arange(64)).tolist()
    got = powers(signals.band_power(epochs(None, [], [1.0], [3.0] * 64, [None] + good[1:], good), 128.0))
    assert all(row == (None,) * 5 for row in got[:5])
    assert None not in got[5]


def test_chunks_do_not_change_the_result(monkeypatch):
    rng = np.random.default_rng(3)
    signals_matrix = rng.normal(size=(10, 32))
    whole = spectrum.relative_power(signals_matrix, 128.0)
    monkeypatch.setattr(spectrum, "CHUNK_SAMPLES", 70)
    parts = list(spectrum._row_chunks(np.arange(10), 32))
    assert [len(p) for p in parts] == [2, 2, 2, 2, 2]
    assert np.allclose(np.vstack([spectrum.relative_power(signals_matrix[p], 128.0) for p in parts]), whole)


FEATURES = "subject_id string, epoch_id long, sleep_stage string, " + ", ".join(
    f"{name}_rel double" for name, _, _ in BANDS
)


@pytest.fixture
def features(frame):
    return frame(
        [
            ("p", 2, "Sleep stage R", 0.5, 0.2, 0.1, 0.1, 0.1),
            ("p", 10, "Sleep stage R", 0.3, 0.4, 0.1, 0.1, 0.1),
            ("p", 1, "Sleep stage W", None, None, None, None, None),
            ("q", 1, "Sleep stage 4", 0.2, 0.2, 0.2, 0.2, 0.2),
        ],
        FEATURES,
    )


def test_means_and_shares(features):
    analytics = signals.signal_analytics(features)
    long = {(r.subject_id, r.sleep_stage, r.band): r for r in signals.spectral_share(analytics).collect()}
    assert long[("p", "Sleep stage R", "delta")].relative_power == pytest.approx(0.4)
    assert long[("p", "Sleep stage R", "theta")].share == pytest.approx(0.3)
    assert long[("p", "Sleep stage W", "delta")].share is None
    assert len(long) == 15
    melted = signals.spectral_long(analytics).collect()
    assert {(r.subject_id, r.sleep_stage, r.band): r.relative_power for r in melted} == {
        k: r.relative_power for k, r in long.items()
    }


def test_hypnogram_order(features):
    got = signals.hypnogram(materialise(features, "features"), "p").collect()
    assert [(r.epoch_id, r.stage_rank, r.delta_rel) for r in got] == [(1, 1, None), (2, 2, 0.5), (10, 2, 0.3)]
    assert [r.subject_id for r in signals.hypnogram(features).collect()] == ["p", "p", "p", "q"]
    assert "timestamp" in signals.hypnogram(features.selectExpr("*", "now() AS timestamp")).columns


def test_epochs_of_samples_equal_the_arrays(spark, frame):
    """Shuffled samples with repeats give the arrays back; gaps, conflicts and samples without a place are told."""
    rng = np.random.default_rng(8)
    arrays = {(s, e): rng.normal(size=16).tolist() for s in ("a", "b") for e in range(5)}
    rows = [(s, e * 16 + k, x) for (s, e), xs in arrays.items() for k, x in enumerate(xs)]
    rows = [r for r in rows if r[:2] not in {("a", 0), ("a", 1), ("a", 5), ("b", 79)}]
    rows += rows[::3] * 4 + [("b", 20, 99.0), ("b", 17, None), (None, 3, 1.0), ("b", None, 1.0), ("b", -1, 1.0), ("c", 160, 1.0)]
    shuffled = [rows[i] for i in rng.permutation(len(rows))]
    got = {(r.subject_id, r.epoch_id): r for r in signals.epochs_of_samples(frame(shuffled, "subject_id string, i long, x double"), 16).collect()}
    assert set(got) == {*arrays, ("c", 10)}
    for key, xs in arrays.items():
        if key not in {("a", 0), ("b", 4)}:
            assert got[key].samples == xs and got[key].missing == 0 and got[key].gaps == []
    first, last, only = got["a", 0], got["b", 4], got["c", 10]
    assert first.samples is None and first.missing == 3 and [tuple(g) for g in first.gaps] == [(0, 1), (5, 5)]
    assert last.samples is None and [tuple(g) for g in last.gaps] == [(15, 15)]
    assert only.missing == 15 and [tuple(g) for g in only.gaps] == [(1, 15)]
    assert got["b", 1].conflicts == 1 and sum(r.conflicts for r in got.values()) == 1
    assert signals.epochs_of_samples(frame([], "subject_id string, i long, x double"), 16).count() == 0
