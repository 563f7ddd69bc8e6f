"""Signals in segments: spectra by batched FFT, coupling between channels and between bands, samples inside condition intervals.

A segment, a recording's hubs and a recording's intervals are small by nature; everything wider (recordings, channels, segments, bins) is a
group or a join that Spark splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.session import ship


def hann(size: int) -> np.ndarray:
    """The periodic window."""
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)


def segment_numbers(t: Column, size: int, step: int) -> Column:
    """The segments that hold sample t: segment s covers s * step to s * step + size - 1."""
    first = F.greatest(F.lit(0).cast("long"), F.ceil((t - size + 1) / step))
    last = F.floor(t / step)
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def middle(rows: DataFrame, keys: list[str], order: str, least: int = 30, most: int = 120) -> DataFrame:
    """The middle `most` rows of each group by order; groups of fewer than `least` go."""
    part = Window.partitionBy(*keys)
    placed = rows.withColumns({"_k": F.row_number().over(part.orderBy(order)) - 1, "_n": F.count("*").over(part)})
    take = F.least(F.col("_n"), F.lit(most))
    first = F.floor((F.col("_n") - take) / 2)
    return placed.where((F.col("_n") >= least) & (F.col("_k") >= first) & (F.col("_k") < first + take)).drop("_k", "_n")


def rfft_segments(samples: DataFrame, keys: list[str], size: int, step: int | None = None, demean: bool = False) -> DataFrame:
    """(keys, segment, re, im): the tapered real FFT of each whole segment of samples (keys, t_idx, v); arrays of size // 2 + 1 bins.

    Overlap by exploded segment numbers (step below size); a segment that lacks a sample is left out, so gaps and the tail give none.
    Null keys are keys like others; a null or NaN sample counts as missing. A repeated sample makes its segments unusable.
    """
    ship(samples.sparkSession)
    step = step or size
    fine = samples.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.col("t_idx") >= 0))
    rows = fine.select(*keys, F.col("t_idx").cast("long").alias("t"), F.col("v").cast("double").alias("v"))
    rows = rows.select(*keys, "t", "v", F.explode(segment_numbers(F.col("t"), size, step)).alias("segment"))
    whole = rows.groupBy(*keys, "segment").agg(F.array_sort(F.collect_list(F.struct("t", "v"))).alias("x"), F.count_distinct("t").alias("n"))
    whole = whole.where((F.size("x") == size) & (F.col("n") == size)).select(*keys, "segment", F.col("x.v").alias("x"))
    taper = hann(size)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, size)
            if demean:
                x = x - x.mean(axis=1, keepdims=True)
            f = np.fft.rfft(x * taper, axis=1)
            ends = pa.array(np.arange(len(f) + 1, dtype=np.int32) * f.shape[1])
            parts = [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(p).ravel())) for p in (f.real, f.imag)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in [*keys, "segment"]), *parts], names=[*keys, "segment", "re", "im"])

    kinds = ", ".join(f"{c} {samples.schema[c].dataType.simpleString()}" for c in keys)
    return whole.mapInArrow(transform, f"{kinds}, segment long, re array<double>, im array<double>")


def periodogram(segments: DataFrame, keys: list[str], low: int = 0, high: int | None = None) -> DataFrame:
    """(keys, k, power, n): the mean over segments of the squared modulus of bins low to high."""
    both = F.arrays_zip("re", "im")
    rows = segments.select(*keys, F.posexplode(both).alias("k", "x")).where(F.col("k") >= low)
    rows = rows.where(F.col("k") <= high) if high is not None else rows
    return rows.groupBy(*keys, "k").agg(F.avg(F.col("x.re") * F.col("x.re") + F.col("x.im") * F.col("x.im")).alias("power"), F.count("*").alias("n"))


def welch(samples: DataFrame, keys: list[str], rate: float, size: int = 1_024, step: int | None = None, low: float = 0.5, high: float = 50.0) -> DataFrame:
    """(keys, freq, psd, n): one-sided power density between two frequencies, by demeaned Hann segments."""
    segments = rfft_segments(samples, keys, size, step, demean=True)
    bins = np.arange(size // 2 + 1) * rate / size
    inside = np.flatnonzero((bins >= low) & (bins <= high))
    rows = periodogram(segments, keys, int(inside[0]), int(inside[-1])) if len(inside) else periodogram(segments, keys).where("false")
    sides = F.when((F.col("k") == 0) | (F.col("k") * 2 == size), 1.0).otherwise(2.0)
    return rows.select(*keys, (F.col("k") * (rate / size)).alias("freq"), (F.col("power") * sides / (rate * float((hann(size) ** 2).sum()))).alias("psd"), "n")


SUMS = ["sr", "si", "sa", "sb", "asi", "si2", "n"]


def cross_spectra(segments: DataFrame, unit: list[str], keep: list[str], channel: str = "channel", low: int = 1, high: int | None = None) -> DataFrame:
    """(keep, ca, cb, k, sums): products of all pairs of channels of one unit (a segment of a recording), summed over units.

    The channels of a unit meet in one row, as a montage is small; pairs are formed in the batch and summed there before the shuffle.
    """
    ship(segments.sparkSession)
    kind = segments.schema[channel].dataType.simpleString()
    rows = segments.groupBy(*dict.fromkeys([*keep, *unit])).agg(F.array_sort(F.collect_list(F.struct(F.col(channel).alias("c"), "re", "im"))).alias("x"))

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            total: dict[tuple, np.ndarray] = {}
            for row in frame.itertuples(index=False):
                names = [x["c"] for x in row.x]
                f = np.array([np.asarray(x["re"], float) + 1j * np.asarray(x["im"], float) for x in row.x])[:, low : None if high is None else high + 1]
                power = np.abs(f) ** 2
                of = tuple(getattr(row, c) for c in keep)
                for i in range(len(names) - 1):
                    s = f[i] * f[i + 1 :].conj()
                    part = np.stack([s.real, s.imag, np.broadcast_to(power[i], s.shape), power[i + 1 :], np.abs(s.imag), s.imag**2, np.ones(s.shape)], axis=1)
                    for j, p in enumerate(part):
                        key = (*of, names[i], names[i + 1 + j])
                        total[key] = total[key] + p if key in total else p
            for key, p in total.items():
                yield pd.DataFrame({**dict(zip([*keep, "ca", "cb"], key, strict=True)), "k": np.arange(p.shape[1]) + low, **dict(zip(SUMS, p, strict=True))})

    kinds = ", ".join([*(f"{c} {segments.schema[c].dataType.simpleString()}" for c in keep), f"ca {kind}", f"cb {kind}", "k long", *(f"{c} double" for c in SUMS)])
    return rows.mapInPandas(pairs, kinds).groupBy(*keep, "ca", "cb", "k").agg(*(F.sum(c).alias(c) for c in SUMS))


def coupling(sums: DataFrame) -> DataFrame:
    """Coherence, imaginary coherence and debiased weighted phase lag of each pair and bin."""
    size = F.nullif(F.sqrt(F.col("sa") * F.col("sb")), F.lit(0.0))
    lag = F.nullif(F.col("asi") * F.col("asi") - F.col("si2"), F.lit(0.0))
    return sums.withColumns({"coh": F.sqrt(F.col("sr") * F.col("sr") + F.col("si") * F.col("si")) / size, "imcoh": F.abs("si") / size, "wpli": (F.col("si") * F.col("si") - F.col("si2")) / lag}).drop(*SUMS)


def edges(coupled: DataFrame, bands: DataFrame, freq: Column) -> DataFrame:
    """Coupling by band (band, lo, hi): the mean over the band's bins."""
    keys = [c for c in coupled.columns if c not in ("k", "coh", "imcoh", "wpli")]
    rows = coupled.withColumn("_f", freq).join(F.broadcast(bands), F.col("_f").between(F.col("lo"), F.col("hi")))
    return rows.groupBy(*keys, "band").agg(F.avg("coh").alias("coh"), F.avg("imcoh").alias("imcoh"), F.avg(F.abs("wpli")).alias("dwpli"))


def phase_and_envelope(signal: DataFrame, keys: list[str], rate: float, bands: dict[str, tuple[float, float]]) -> DataFrame:
    """(keys, t, phase_<band>, envelope_<band>, ...): analytic signals of each whole signal (keys, t_idx, v) in several bands at once.

    The spectrum outside the band is set to zero and negative frequencies are dropped, so a group (one recording's hub) is one FFT.
    """
    ship(signal.sparkSession)
    whole = signal.where("v is not null").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("t_idx").cast("long").alias("t"), F.col("v").cast("double").alias("v")))).alias("x"))
    names = [f"{kind}_{b}" for b in bands for kind in ("phase", "envelope")]

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x = batch.column("x").slice(r, 1).flatten()
                t, v = x.field("t"), x.field("v").to_numpy()
                f, s = np.fft.fftfreq(len(v), 1 / rate), np.fft.fft(v)
                columns = []
                for low, high in bands.values():
                    y = np.fft.ifft(np.where((f >= low) & (f <= high), 2 * s, 0))
                    columns += [pa.array(np.angle(y)), pa.array(np.abs(y))]
                one = pa.array(np.full(len(v), r))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(one) for c in keys), t, *columns], names=[*keys, "t", *names])

    kinds = ", ".join(f"{c} {signal.schema[c].dataType.simpleString()}" for c in keys)
    return whole.mapInArrow(transform, f"{kinds}, t long, {', '.join(f'{n} double' for n in names)}")


def modulation_index(rows: DataFrame, keys: list[str], bins: int = 18) -> DataFrame:
    """(keys, modulation) of rows (keys, phase, envelope): normalised entropy of the mean envelope by phase bin; empty bins count 1e-12, phase pi is in none."""
    place = F.floor((F.col("phase") + float(np.pi)) / (2 * float(np.pi) / bins))
    mean = rows.withColumn("bin", place).where(F.col("bin").between(0, bins - 1)).groupBy(*keys, "bin").agg(F.avg("envelope").alias("amp"))
    total = F.sum("amp")
    # sum(p ln p) over the bins that are there, from sums: p = amp / total.
    log_sum = F.sum(F.when(F.col("amp") > 0, F.col("amp") * F.ln("amp")))
    there = F.count_if(F.col("amp") > 0)
    got = mean.groupBy(*keys).agg(total.alias("total"), log_sum.alias("s"), there.alias("there"))
    p_log_p = F.col("s") / F.col("total") - F.ln("total") + (bins - F.col("there")) * float(1e-12 * np.log(1e-12))
    h_max = float(np.log(bins))
    return got.select(*keys, F.when(F.col("total") > 0, (h_max + p_log_p) / h_max).otherwise(0.0).alias("modulation"))


def cross_frequency(signal: DataFrame, keys: list[str], pairs: DataFrame, rate: float, phase_band: tuple[float, float], amplitude_band: tuple[float, float], bins: int = 18) -> DataFrame:
    """(keys, phase_hub, amplitude_hub, modulation) of hub signals (keys, hub, t_idx, v): within each hub, and for the pairs (keys it shares, phase_hub, amplitude_hub)."""
    both = phase_and_envelope(signal, [*keys, "hub"], rate, {"p": phase_band, "a": amplitude_band})
    # One row for each hub: its samples in order, so that pairs join rows of hubs and not of samples.
    packed = both.groupBy(*keys, "hub").agg(F.array_sort(F.collect_list(F.struct("t", F.col("phase_p").alias("phase"), F.col("envelope_a").alias("envelope")))).alias("x"))
    shared = [c for c in keys if c in pairs.columns]
    own = packed.select(*keys, F.col("hub").alias("phase_hub"), F.col("hub").alias("amplitude_hub"), F.col("x.phase").alias("phase"), F.col("x.envelope").alias("envelope"))
    first = packed.select(*keys, F.col("hub").alias("phase_hub"), F.col("x.phase").alias("phase")).join(F.broadcast(pairs), [*shared, "phase_hub"])
    second = packed.select(*keys, F.col("hub").alias("amplitude_hub"), F.col("x.envelope").alias("envelope"))
    across = first.join(second, [*keys, "amplitude_hub"]).select(*own.columns)
    rows = own.unionByName(across).select(*keys, "phase_hub", "amplitude_hub", F.explode(F.arrays_zip("phase", "envelope")).alias("z")).select(*keys, "phase_hub", "amplitude_hub", "z.phase", "z.envelope")
    return modulation_index(rows, [*keys, "phase_hub", "amplitude_hub"], bins)


def extract_segments(samples: DataFrame, intervals: DataFrame, rate: float, least: float = 5.0, bucket: float = 30.0) -> DataFrame:
    """Samples (recording_id, channel, t_idx, v) inside intervals (recording_id, condition, start, stop), joined end to end for each condition.

    Intervals are clamped to the recording (from 0 to its last sample), ones shorter than `least` seconds after that go, and so do
    reversed, null or repeated ones. A condition's intervals follow each other by start; overlapping ones each take their
    samples. Gives (recording_id, condition, channel, segment, t_idx, source_idx, v): t_idx counts from 0 without gaps over a condition's
    segments. The join is on recording and time bucket, so a long recording meets an interval only where it may lie.
    """
    ends = samples.groupBy("recording_id").agg(F.max(F.col("t_idx").cast("long")).alias("last"))
    found = intervals.where("start < stop").select("recording_id", "condition", "start", "stop").distinct().join(ends, "recording_id")
    # Whole samples: the first at or after start, the last at or before the clamped stop.
    clamped = F.least(F.col("stop"), F.col("last") / rate)
    lo, hi = F.ceil(F.round(F.greatest(F.col("start"), F.lit(0.0)) * rate, 6)), F.floor(F.round(clamped * rate, 6))
    found = found.withColumns({"from": lo.cast("long"), "to": hi.cast("long")}).where((clamped - F.greatest(F.col("start"), F.lit(0.0)) >= least) & (F.col("to") >= F.col("from")))
    order = Window.partitionBy("recording_id", "condition").orderBy("from", "to", "start", "stop")
    size = F.col("to") - F.col("from") + 1
    placed = found.withColumns({"segment": F.row_number().over(order) - 1, "before": F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    width = max(1, int(bucket * rate))
    cells = placed.select("recording_id", "condition", "segment", "from", "to", "before", F.explode(F.sequence(F.floor(F.col("from") / width), F.floor(F.col("to") / width))).alias("cell"))
    rows = samples.select("recording_id", "channel", F.col("t_idx").cast("long").alias("source_idx"), "v").withColumn("cell", F.floor(F.col("source_idx") / width))
    inside = rows.join(cells, ["recording_id", "cell"]).where(F.col("source_idx").between(F.col("from"), F.col("to")))
    return inside.select("recording_id", "condition", "channel", F.col("segment").cast("long").alias("segment"), (F.col("before") + F.col("source_idx") - F.col("from")).alias("t_idx"), "source_idx", "v")


def with_fallback(first: DataFrame, second: DataFrame) -> DataFrame:
    """Intervals of the first source; those of the second for recordings that the first has none for."""
    return first.unionByName(second.join(first.select("recording_id").distinct(), "recording_id", "left_anti"))
