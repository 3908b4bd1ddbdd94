"""The registered queries once more, with every key heavy and every chunk small."""

import pytest
from compare import differences, duck

from __spark_entry__ import oracle_sql, queries
from sigspark.operators import segments

SF = "/root/testdata/sf0.001"
NAMES = [
    "q_frame_rms", "q_frames_overlap", "q_gradient_stats", "q_envelope", "q_feature_vector", "q_peak_normalise",
    "q_signal_slice", "q_resample_linear", "q_spec_centroid", "q_label_codes", "q_random_split", "q_prepare",
    "q_balanced_sample", "q_augment_plan", "q_derived_names", "q_class_weights", "q_length_histogram", "q_time_stretch",
]


@pytest.fixture
def tight(monkeypatch):
    monkeypatch.setattr(segments, "HEAVY_ROWS", 20)
    monkeypatch.setattr(segments, "CHUNK", 4)


@pytest.mark.parametrize("name", [n for n in NAMES if n in oracle_sql()])
def test_heavy_keys_give_the_same(spark, tight, name):
    con = duck(SF)
    con.execute("SET TimeZone='UTC'")
    got = queries()[name](spark, SF).toArrow()
    assert differences(got, con.execute(oracle_sql()[name]).to_arrow_table()) == []


def test_salted_joins_give_the_same(spark, monkeypatch):
    con = duck(SF)
    small = segments.join_small
    monkeypatch.setattr("sigspark.operators.ranking.join_small", lambda *a, **k: small(*a, **{**k, "max_rows": 2}))
    for name in ("q_random_split", "q_stratified_split", "q_class_weights"):
        got = queries()[name](spark, SF).toArrow()
        assert differences(got, con.execute(oracle_sql()[name]).to_arrow_table()) == []
