"""Spectra and coupling over all bins and bands, against numpy."""

from collections import defaultdict

import numpy as np

from plumbline import registry
from plumbline.sources.fixtures import BANDS

SF = "/root/testdata/sf0.001"


def test_all_bins_and_bands_equal_numpy(spark):
    signal = defaultdict(dict)
    for x in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect():
        signal[x.vec_id % 5][x.vec_id // 5] = np.array(x.embedding, float)
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(64) / 64)
    spec = {c: {e: np.fft.rfft(v * taper) for e, v in es.items()} for c, es in signal.items()}
    power = {(x.channel, x.k): x.power for x in registry.queries()["k2_welch"](spark, SF).collect()}
    assert set(power) == {(c, k) for c in spec for k in range(1, 33)}
    for c, k in power:
        assert abs(power[c, k] - np.mean([abs(s[k]) ** 2 for s in spec[c].values()])) < 2e-6
    want = {}
    for a in spec:
        for b in (b for b in spec if b > a):
            both = sorted(spec[a].keys() & spec[b].keys())
            x, y = (np.array([spec[c][e] for e in both]) for c in (a, b))
            coh = abs((x * y.conj()).sum(axis=0)) / np.sqrt((abs(x) ** 2).sum(axis=0) * (abs(y) ** 2).sum(axis=0))
            for band, (lo, hi) in BANDS.items():
                want[a, b, band] = np.mean([coh[k] for k in range(1, 33) if lo <= k <= hi])
    got = {(x.ca, x.cb, x.band): x.coh for x in registry.queries()["c2_coherence"](spark, SF).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)
