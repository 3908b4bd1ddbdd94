"""Onset lists from chunks against a scan from the first frame to the last."""

import numpy as np
import pytest

from sigspark.operators import onset_lists, onsets


def scan(peaks, wait):
    out = []
    for p in sorted(peaks):
        if not out or p > out[-1] + wait:
            out.append(p)
    return out


@pytest.mark.parametrize("wait,size,fan", [(6, 7, 2), (6, 7, 3), (3, 100, 2), (0, 5, 4), (12, 13, 64), (30, 31, 5)])
def test_picks_equal_a_scan(spark, wait, size, fan):
    rng = np.random.default_rng(wait + size)
    peaks = {
        "dense": range(400), "sparse": np.flatnonzero(rng.uniform(size=3000) < 0.01), "half": np.flatnonzero(rng.uniform(size=1500) < 0.5), "one": [5],
        "late": [2999], "gaps": [i for i in range(900) if i // 50 % 3 == 0], "even": range(0, 700, wait + 1), "odd": range(0, 700, max(wait, 1)),
    }
    marked = spark.createDataFrame([(k, int(i)) for k, v in peaks.items() for i in v], "signal_id string, frame_idx long")
    got = {}
    for r in onset_lists.onsets(marked, wait, size, fan).collect():
        got.setdefault(r.signal_id, []).append(r.frame_idx)
    assert {k: sorted(v) for k, v in got.items()} == {k: scan(map(int, v), wait) for k, v in peaks.items()}


def frames(spark):
    rng = np.random.default_rng(4)
    rows = []
    for key, n in (("a", 260), ("b", 41), ("c", 1), ("d", 3)):
        power = np.exp(rng.normal(0, 3, (n, 4)))
        power[::17] = 0
        rows += [(key, i, power[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "signal_id string, frame_idx long, power array<double>")


@pytest.mark.parametrize("shift", [0, 2, 9])
def test_envelope_in_chunks_equals_whole_windows(spark, shift):
    want = {(r.signal_id, r.frame_idx): r.strength for r in onsets.onset_envelope(frames(spark), shift).collect()}
    got = {(r.signal_id, r.frame_idx): r.strength for r in onset_lists.onset_envelope(frames(spark), shift, size=10).collect()}
    assert got.keys() == want.keys() and len(got) == 305
    assert np.allclose([got[k] for k in want], list(want.values()))


def test_first_two_of_the_list_are_the_first_two(spark):
    env = onsets.onset_envelope(frames(spark))
    two = {r.signal_id: (r.first_onset, r.second_onset) for r in onsets.first_two_onsets(env, 3, 5, 0.07, 4).collect()}
    lists = {k: [] for k in two}
    for r in onset_lists.onset_list(frames(spark), 3, 5, 0.07, 4, size=11, fan=3).collect():
        lists[r.signal_id].append(r.frame_idx)
    assert {k: tuple((sorted(v) + [None, None])[:2]) for k, v in lists.items()} == two
    assert len(lists["a"]) > 10


def test_nothing_to_pick(spark):
    none = spark.createDataFrame([], "signal_id string, frame_idx long")
    assert onset_lists.onsets(none, 6).collect() == []
    with pytest.raises(ValueError, match="longer"):
        onset_lists.onsets(none, 6, size=6)
