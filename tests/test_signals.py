"""Segmented spectra, coupling, cross-frequency coupling, extracted segments and graph measures, against numpy and plain loops."""

import itertools
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import signals
from plumbline.operators.grouped import measure_graph
from plumbline.sources import parameters


def frame(spark, rows, kind="recording_id long, channel string, t_idx long, v double"):
    return spark.createDataFrame(rows, kind)


def test_segments_of_1024_points_at_256_hz_equal_numpy(spark):
    r = np.random.default_rng(0)
    signal = {(i, c): r.standard_normal(3_000) + np.sin(2 * np.pi * 10 * np.arange(3_000) / 256) for i in range(2) for c in ("Fz", "Pz")}
    rows = [(i, c, t, float(v)) for (i, c), x in signal.items() for t, v in enumerate(x)]
    df = frame(spark, rows).repartition(5)
    got = {(x.recording_id, x.channel, x.segment): np.array(x.re) + 1j * np.array(x.im) for x in signals.rfft_segments(df, ["recording_id", "channel"], 1_024, 512).collect()}
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(1_024) / 1_024)
    assert set(got) == {(*k, s) for k in signal for s in range(4)}
    for (i, c, s), f in got.items():
        assert np.abs(f - np.fft.rfft(signal[i, c][512 * s : 512 * s + 1_024] * taper)).max() < 1e-9
    psd = defaultdict(dict)
    for x in signals.welch(df, ["recording_id", "channel"], 256.0, 1_024, 1_024).collect():
        psd[x.recording_id, x.channel][x.freq] = x.psd
    for k, x in signal.items():
        parts = np.array([(p - p.mean()) * taper for p in x[:2_048].reshape(2, 1_024)])
        want = 2 * (np.abs(np.fft.rfft(parts, axis=1)) ** 2).mean(axis=0) / (256 * (taper**2).sum())
        assert sorted(psd[k]) == [f / 4 for f in range(2, 201)]
        assert all(abs(p - want[round(4 * f)]) < 1e-12 for f, p in psd[k].items()) and max(psd[k], key=psd[k].get) == 10.0


def test_gaps_tails_and_bad_samples_leave_no_segment(spark):
    rows = [(1, "a", t, 1.0) for t in range(20) if t != 9] + [(2, "a", t, None if t == 3 else float(t)) for t in range(8)] + [(3, "a", t, float(t)) for t in (0, 1, 2, 3, 3)] + [(None, "a", t, 1.0) for t in range(4)]
    got = sorted((str(x.recording_id), x.segment) for x in signals.rfft_segments(frame(spark, rows), ["recording_id", "channel"], 4).collect())
    assert got == [("1", 0), ("1", 1), ("1", 3), ("1", 4), ("2", 1), ("None", 0)]
    assert signals.rfft_segments(frame(spark, []), ["recording_id", "channel"], 4).count() == 0


def test_cross_spectra_equal_numpy(spark):
    r = np.random.default_rng(1)
    f = {(c, e): r.standard_normal(9) + 1j * r.standard_normal(9) for c in "abc" for e in range(30) if (c, e) != ("b", 4)}
    rows = spark.createDataFrame([(c, e, x.real.tolist(), x.imag.tolist()) for (c, e), x in f.items()], "channel string, epoch long, re array<double>, im array<double>").repartition(4)
    got = signals.coupling(signals.cross_spectra(rows, ["epoch"], []))
    seen = 0
    for x in got.collect():
        both = [e for e in range(30) if (x.ca, e) in f and (x.cb, e) in f]
        s = np.array([f[x.ca, e][x.k] * f[x.cb, e][x.k].conj() for e in both])
        power = np.sqrt(sum(abs(f[x.ca, e][x.k]) ** 2 for e in both) * sum(abs(f[x.cb, e][x.k]) ** 2 for e in both))
        assert abs(x.coh - abs(s.sum()) / power) < 1e-12 and abs(x.imcoh - abs(s.imag.sum()) / power) < 1e-12
        assert abs(x.wpli - (s.imag.sum() ** 2 - (s.imag**2).sum()) / (np.abs(s.imag).sum() ** 2 - (s.imag**2).sum())) < 1e-12
        seen += 1
    assert seen == 3 * 8


def test_coupled_hubs_score_above_uncoupled_ones(spark):
    r, t = np.random.default_rng(2), np.arange(2_560) / 256
    theta = np.sin(2 * np.pi * 6 * t)
    hubs = {"A": theta + 0.5 * (1 + theta) * np.sin(2 * np.pi * 38 * t), "B": np.sin(2 * np.pi * 5.3 * t + 1) + 0.5 * np.sin(2 * np.pi * 38 * t), "C": 0.5 * (1 + theta) * np.sin(2 * np.pi * 38 * t)}
    rows = [(1, h, k, float(v + 0.05 * r.standard_normal())) for h, x in hubs.items() for k, v in enumerate(x)]
    pairs = spark.createDataFrame([("A", "C"), ("B", "C"), ("A", "missing")], "phase_hub string, amplitude_hub string")
    got = {(x.phase_hub, x.amplitude_hub): x.modulation for x in signals.cross_frequency(frame(spark, rows, "recording_id long, hub string, t_idx long, v double"), ["recording_id"], pairs, 256.0, (4, 8), (30, 45)).collect()}
    assert set(got) == {("A", "A"), ("B", "B"), ("C", "C"), ("A", "C"), ("B", "C")}
    assert got["A", "A"] > 5 * got["B", "B"] and got["A", "C"] > 5 * got["B", "C"] and got["A", "A"] > 0.01


def test_modulation_index_by_hand(spark):
    rows = [(1, -3.0, 2.0), (1, -3.0, 4.0), (1, 0.1, 1.0), (1, float(np.pi), 99.0), (2, 0.0, 0.0)]
    got = {x.k: x.modulation for x in signals.modulation_index(spark.createDataFrame(rows, "k long, phase double, envelope double"), ["k"]).collect()}
    p = np.r_[0.75, 0.25, np.full(16, 1e-12)]
    assert abs(got[1] - (np.log(18) + (p * np.log(p)).sum()) / np.log(18)) < 1e-12 and got[2] == 0.0


def test_extracted_segments_equal_a_plain_loop(spark):
    r, rate = np.random.default_rng(3), 4.0
    length = {1: 400, 2: 90, 3: 10}
    samples = [(i, c, t, float(t + 1_000 * i)) for i, n in length.items() for c in ("Fz", "Pz") for t in range(n)]
    intervals = [(int(r.integers(1, 5)), str(r.choice(["eo", "ec"])), float(a := round(r.uniform(-5, 110), 2)), float(a + round(r.uniform(-3, 20), 2))) for _ in range(60)]
    intervals += [intervals[0], (1, "eo", None, 5.0), (1, "eo", 7.0, None), (1, "eo", 9.0, 9.0), (2, "eo", 0.0, 1e9), (1, None, 10.0, 20.0)]
    df, iv = frame(spark, samples).repartition(6), spark.createDataFrame(intervals, "recording_id long, condition string, start double, stop double")
    got = sorted(((x.recording_id, str(x.condition), x.channel, x.segment, x.t_idx, x.source_idx, x.v) for x in signals.extract_segments(df, iv, rate, 5.0, bucket=7.0).collect()))
    want = []
    for i, n in length.items():
        for c in ("eo", "ec", None):
            at = seg = 0
            kept = [(a, b) for j, d, a, b in set(intervals) if j == i and d == c and a is not None and b is not None and a < b and min(b, (n - 1) / rate) - max(a, 0) >= 5]
            for a, b in sorted(kept, key=lambda x: (np.ceil(max(x[0], 0) * rate), np.floor(min(x[1], (n - 1) / rate) * rate), *x)):
                lo, hi = int(np.ceil(round(max(a, 0) * rate, 6))), int(np.floor(round(min(b, (n - 1) / rate) * rate, 6)))
                want += [(i, str(c), ch, seg, at + t - lo, t, float(t + 1_000 * i)) for t in range(lo, hi + 1) for ch in ("Fz", "Pz")]
                at, seg = at + hi - lo + 1, seg + 1
    assert got == sorted(want)
    ends = defaultdict(set)
    for i, c, ch, _, t, _, _ in got:
        ends[i, c, ch].add(t)
    assert all(ts == set(range(len(ts))) for ts in ends.values())
    plan = signals.extract_segments(df, iv, rate)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fallback_intervals(spark):
    kind = "recording_id long, condition string, start double, stop double"
    first, second = spark.createDataFrame([(1, "eo", 0.0, 9.0)], kind), spark.createDataFrame([(1, "ec", 0.0, 9.0), (2, "ec", 1.0, 9.0)], kind)
    assert sorted(x.recording_id * 10 + x.start for x in signals.with_fallback(first, second).collect()) == [10, 21]


def brute_graph(edges, inverse):
    """Measures by listing simple paths."""
    names = sorted({x for e in edges for x in e[:2]})
    w = {frozenset(e[:2]): e[2] for e in edges}
    n = len(names)

    def paths(a, b, seen):
        if a == b:
            yield [b]
            return
        for c in names:
            if c not in seen and frozenset((a, c)) in w:
                for p in paths(c, b, seen | {c}):
                    yield [a, *p]

    far = lambda p: sum(1 / w[frozenset(x)] if inverse else w[frozenset(x)] for x in itertools.pairwise(p))
    every = {(a, b): list(paths(a, b, {a})) for a, b in itertools.permutations(names, 2)}
    efficiency = sum(1 / min(len(p) - 1 for p in ps) for ps in every.values() if ps) / (n * (n - 1))
    reach = {a: {a} | {b for b in names if b != a and every[a, b]} for a in names}
    core = reach[max(names, key=lambda a: (len(reach[a]), -names.index(a)))]
    length = np.mean([min(map(far, every[a, b])) for a, b in itertools.permutations(core, 2)])
    top, cluster = max(w.values()), []
    for a in names:
        near = [b for b in names if frozenset((a, b)) in w and b != a]
        tri = [(w[frozenset((a, b))] * w[frozenset((a, c))] * w[frozenset((b, c))] / top**3) ** (1 / 3) for b, c in itertools.permutations(near, 2) if frozenset((b, c)) in w]
        cluster.append(sum(tri) / (len(near) * (len(near) - 1)) if len(near) > 1 else 0)
    share = dict.fromkeys(names, 0.0)
    for (a, b), ps in every.items():
        best = [p for p in ps if far(p) < min(map(far, ps)) + 1e-9]
        for v in names:
            if v not in (a, b) and best:
                share[v] += sum(v in p for p in best) / len(best)
    return n, efficiency, length, float(np.mean(cluster)), max(share.values()) / ((n - 1) * (n - 2)) if n > 2 else 0.0


@pytest.mark.parametrize("inverse", [False, True])
def test_graph_measures_equal_listed_paths(inverse):
    r = np.random.default_rng(4)
    for trial in range(25):
        names = "abcdef"[: int(r.integers(2, 7))]
        edges = [(a, b, float(r.choice([0.5, 1.0, 2.0]))) for a, b in itertools.combinations(names, 2) if r.random() < 0.6] or [("a", "b", 1.0)]
        got = measure_graph([dict(zip(("ca", "cb", "weight"), e, strict=True)) for e in edges], inverse)
        assert np.allclose([got[k] for k in ("n_nodes", "efficiency", "path_length", "clustering", "max_betweenness")], brute_graph(edges, inverse)), trial


def test_the_most_specific_parameters_win(spark):
    more = [parameters.scalar("line_freq", 16.7, dataset=1, montage="37"), *parameters.listed("pairs", [("X1", "X2")], dataset=0), parameters.scalar("new", 5, montage="37")]
    units = spark.createDataFrame([(0, "19"), (0, "37"), (1, "19"), (1, "37"), (1, "37"), (7, None)], "dataset long, montage string")
    got = parameters.resolve(parameters.parameters(spark, more), units).collect()
    value = {(x.dataset, x.montage, x.name): x.value for x in got}
    assert [value[k, m, "line_freq"] for k, m in ((0, "19"), (0, "37"), (1, "19"), (1, "37"), (7, None))] == [60.0, 60.0, 50.0, 16.7, 60.0]
    pairs = defaultdict(set)
    for x in got:
        if x.name == "pairs":
            pairs[x.dataset, x.montage].add((x.key, x.item))
    assert pairs[0, "37"] == pairs[0, "19"] == {("X1", "X2")} and len(pairs[1, "37"]) == 16 and len(pairs[1, "19"]) == len(pairs[7, None]) == 7
    assert ("new" in {n for d, m, n in value if m == "37"}) and (0, "19", "new") not in value
    hubs = {(x.montage, x.key) for x in got if x.name == "hubs" and x.dataset == 0}
    assert len([h for m, h in hubs if m == "19"]) == 10 and len([h for m, h in hubs if m == "37"]) == 15


def test_montages_give_other_groups(spark):
    from plumbline import registry

    sf = "/root/testdata/sf0.01"
    rows = registry.queries()["k7_asymmetry"](spark, sf).groupBy("montage").agg(F.collect_set(F.struct("lft", "rgt")).alias("p")).collect()
    got = {x.montage: {tuple(p) for p in x.p} for x in rows}
    assert got["19"] == set(parameters.PAIRS) and got["37"] == set(parameters.PAIRS + parameters.MORE_PAIRS)
