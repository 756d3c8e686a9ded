"""The chunked band-stop against a plain loop over whole recordings."""

import numpy as np
import pytest

from mnesis.operators import notch

SCHEMA = "eegfile string, pair_idx int, samplerate double, chunk_id long, samples array<double>"


def looped(x, sections):
    """Sections one after the other, sample by sample, begun at rest in the first sample."""
    for b, a in sections:
        s2 = x[0] * (b[2] - a[2])
        s1 = x[0] * (b[1] - a[1]) + s2
        y = np.empty(len(x))
        for t, u in enumerate(x):
            y[t] = b[0] * u + s1
            s1, s2 = b[1] * u - a[1] * y[t] + s2, b[2] * u - a[2] * y[t]
        x = y
    return x


def both_ways(x, rate, low=58.0, high=62.0, order=4):
    s = notch.sections(low, high, rate, order)
    return looped(looped(x, s)[::-1], s)[::-1]


def test_sections_stop_the_band_alone():
    for rate in (256.0, 500.0, 1000.0):
        z = np.exp(2j * np.pi * np.array([0.0, 20.0, 50.0, 58.0, 60.0, 62.0, 70.0, 100.0]) / rate)
        gain = np.abs(np.prod([np.polyval(b, z) / np.polyval(a, z) for b, a in notch.sections(58.0, 62.0, rate)], axis=0))
        assert np.allclose(gain[[0, 1]], 1, atol=1e-6) and np.allclose(gain[[3, 5]], np.sqrt(0.5), atol=1e-6) and gain[4] < 1e-3 and gain[[2, 6, 7]].min() > 0.99


@pytest.mark.parametrize("sizes", [[100], [37, 64, 100, 1]])
def test_chunks_are_filtered_as_whole_recordings(spark, sizes):
    r, rate, n = np.random.default_rng(1), 256.0, 900
    whole = {("f", 0): 5 + r.normal(size=n), ("f", 1): np.sin(2 * np.pi * 60 * np.arange(n) / rate) + np.sin(2 * np.pi * 10 * np.arange(n) / rate), ("g", 0): r.normal(size=n).cumsum()}
    rows = []
    for (f, p), x in whole.items():
        at = k = 0
        while at < n:
            size = sizes[k % len(sizes)]
            rows.append((f, p, rate, k, x[at : at + size].tolist()))
            at, k = at + size, k + 1
    got = {}
    for q in notch.without_band(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect():
        got.setdefault((q.eegfile, q.pair_idx), {})[q.chunk_id] = q.samples
    for key, x in whole.items():
        y = np.concatenate([got[key][k] for k in sorted(got[key])])
        assert len(y) == n and np.allclose(y, both_ways(x, rate), atol=1e-7 * max(1, np.abs(x).max()))
    assert np.abs(np.concatenate([got["f", 1][k] for k in sorted(got["f", 1])]) - np.sin(2 * np.pi * 10 * np.arange(n) / rate))[300:600].max() < 0.05


def test_gaps_end_a_recording(spark):
    r, rate = np.random.default_rng(2), 128.0
    a, b = r.normal(size=80), r.normal(size=120)
    rows = [("f", 0, rate, 0, a[:40].tolist()), ("f", 0, rate, 1, a[40:].tolist()), ("f", 0, rate, 3, b[:60].tolist()), ("f", 0, rate, 4, b[60:].tolist()), ("f", 1, rate, 0, []), ("f", 2, rate, 0, None)]
    got = {q.chunk_id: q.samples for q in notch.without_band(spark.createDataFrame(rows, SCHEMA), 20.0, 24.0, 2).collect()}
    assert np.allclose(np.concatenate((got[0], got[1])), both_ways(a, rate, 20.0, 24.0, 2)) and np.allclose(np.concatenate((got[3], got[4])), both_ways(b, rate, 20.0, 24.0, 2)) and set(got) == {0, 1, 3, 4}
    assert notch.without_band(spark.createDataFrame([], SCHEMA)).count() == 0
