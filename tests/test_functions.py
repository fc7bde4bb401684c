import math

import pytest
from pyspark.sql import functions as F

from studymart import functions as fn


def evaluate(frame, value, ddl, expression):
    return frame([(value,)], f"v {ddl}").select(expression(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "index, label",
    [
        (0.0, "Normal"),
        (4.999, "Normal"),
        (5.0, "Mild"),
        (14.999, "Mild"),
        (15.0, "Moderate"),
        (29.999, "Moderate"),
        (30.0, "Severe"),
        (None, "Severe"),
        (math.nan, "Severe"),
        (math.inf, "Severe"),
    ],
)
def test_severity_bounds(frame, index, label):
    assert evaluate(frame, index, "double", fn.ahi_severity) == label


@pytest.mark.parametrize("index", [None, math.nan])
def test_severity_of_unknown_index_can_be_named(frame, index):
    assert evaluate(frame, index, "double", lambda c: fn.ahi_severity(c, "Unknown")) == "Unknown"


@pytest.mark.parametrize(
    "kind, expected",
    [
        ("apnea", "apnea"),
        ("hypopnea", "hypopnea"),
        ("arousal", "arousal"),
        ("Apnea", "other"),
        (" apnea", "other"),
        ("snore", "other"),
        ("", "other"),
        (None, "other"),
    ],
)
def test_event_type(frame, kind, expected):
    assert evaluate(frame, kind, "string", fn.normalise_event_type) == expected


def test_event_type_keep_list(frame):
    keep = lambda c: fn.normalise_event_type(c, ["snore"], "rest")
    assert evaluate(frame, "snore", "string", keep) == "snore"
    assert evaluate(frame, "apnea", "string", keep) == "rest"


@pytest.mark.parametrize("minutes, expected", [(0.0, None), (None, None), (120.0, 3.0)])
def test_ahi(frame, minutes, expected):
    assert evaluate(frame, minutes, "double", lambda c: fn.ahi(F.lit(4), F.lit(2), c)) == expected


def test_percentage(frame):
    assert evaluate(frame, 0.0, "double", lambda c: fn.percentage(F.lit(5.0), c)) is None
    assert evaluate(frame, 50.0, "double", lambda c: fn.percentage(F.lit(5.0), c)) == 10.0


@pytest.mark.parametrize(
    "text, expected", [("NULL", None), ("null", None), ("", None), (None, None), ("Null", "Null"), ("x", "x")]
)
def test_null_tokens(frame, text, expected):
    assert evaluate(frame, text, "string", fn.null_if_token) == expected


@pytest.mark.parametrize(
    "stage, rank", [("Sleep stage W", 1), ("Sleep stage R", 2), ("Sleep stage 4", 6), ("Movement", None), (None, None)]
)
def test_stage_rank(frame, stage, rank):
    assert evaluate(frame, stage, "string", fn.stage_rank) == rank


def test_band_label(frame):
    assert evaluate(frame, "avg_delta_rel", "string", fn.band_label) == "delta"
    assert evaluate(frame, "AVG_GAMMA_REL", "string", fn.band_label) == "GAMMA"
