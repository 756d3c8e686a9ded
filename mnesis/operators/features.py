"""Spectral features of epochs. Each row is one (event, pair) with an array of samples; numpy works on Arrow slices of them,
so Spark spreads the rows and a task holds a slice at a time.

Conventions, as filters and wavelets have many: a band-stop sets the band's bins of the spectrum to zero; a Morlet wavelet
of ``width`` cycles at f has the deviation width / (2 pi f) in time, unit energy, and is applied as a product in the
spectrum; edges are mirrored by ``buffer`` seconds and cut off afterwards; power is the squared size, its logarithm to base
10 if asked, and its mean over time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mnesis.operators import masks, sequence
from mnesis.schemas import FRParameters

EPSILON = 1e-12


def mirrored(x: np.ndarray, n: int) -> np.ndarray:
    """Samples (rows of x) with n mirrored ones on either side, as far as there are so many."""
    n = min(n, x.shape[1] - 1)
    return x if n <= 0 else np.concatenate((x[:, n:0:-1], x, x[:, -2 : -n - 2 : -1]), axis=1)


def band_stop(x: np.ndarray, rate: float, low: float = 58.0, high: float = 62.0) -> np.ndarray:
    spectrum = np.fft.rfft(x, axis=1)
    f = np.fft.rfftfreq(x.shape[1], 1 / rate)
    spectrum[:, (f >= low) & (f <= high)] = 0
    return np.fft.irfft(spectrum, x.shape[1], axis=1)


def morlet_power(x: np.ndarray, rate: float, frequencies: list[float], width: float) -> np.ndarray:
    """(row, frequency, sample)"""
    spectrum = np.fft.fft(x, axis=1)
    f = np.fft.fftfreq(x.shape[1], 1 / rate)
    out = np.empty((x.shape[0], len(frequencies), x.shape[1]))
    for k, f0 in enumerate(frequencies):
        s = width / (2 * np.pi * f0)
        shape = np.sqrt(2 * s * np.sqrt(np.pi) * rate) * np.exp(-0.5 * (2 * np.pi * s * (f - f0)) ** 2) * (f > 0)
        out[:, k] = np.abs(np.fft.ifft(spectrum * shape, axis=1)) ** 2
    return out


def by_length(frame: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows of equal sample rate and length together, as a matrix."""
    if len(frame):
        for _, own in frame.groupby(["samplerate", frame["samples"].map(len)], sort=False):
            if len(own["samples"].iloc[0]):
                yield own, np.stack(own["samples"].to_numpy()).astype(np.float64)


def powers(epochs: DataFrame, keys: list[str], frequencies: list[float], width: float = 5.0, buffer: float = 0.5, log: bool = True, recorded: bool = False) -> DataFrame:
    """(keys, freq_idx, power) of epochs with samples and samplerate. recorded: the epochs have the buffer on both sides, so
    that none is mirrored."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own, x in by_length(frame):
                rate = float(own["samplerate"].iloc[0])
                if recorded:
                    pad = min(int(buffer * rate), (x.shape[1] - 1) // 2)
                    p = morlet_power(band_stop(x, rate), rate, frequencies, width)[:, :, pad : x.shape[1] - pad]
                else:
                    pad = min(int(buffer * rate), x.shape[1] - 1)
                    p = morlet_power(band_stop(mirrored(x, pad), rate), rate, frequencies, width)[:, :, pad : pad + x.shape[1]]
                p = (np.log10(p + EPSILON) if log else p).mean(axis=2)
                out = own[keys].loc[own.index.repeat(len(frequencies))].reset_index(drop=True)
                out["freq_idx"], out["power"] = np.tile(np.arange(len(frequencies), dtype=np.int32), len(own)), p.reshape(-1)
                yield out

    types = dict(epochs.dtypes)
    return epochs.select(*keys, "samples", "samplerate").mapInPandas(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "freq_idx int, power double"]))


def normalized_powers(epochs: DataFrame, frequencies: list[float], session_keys: list[str], partition: str | None = None, **settings) -> DataFrame:
    """``powers`` in sample deviations within session (and partition), pair and frequency."""
    keys = [*dict.fromkeys([*session_keys, *([partition] if partition else []), "event_id", "pair_idx"])]
    p = powers(epochs, keys, frequencies, **settings)
    group = [*session_keys, *([partition] if partition else []), "pair_idx", "freq_idx"]
    return p.withColumn("power", sequence.zscore(p, group, "power"))


def partition_powers(events: DataFrame, chunks: DataFrame, p: FRParameters, session_keys: list[str]) -> DataFrame:
    """(session_keys, partition, event_id, pair_idx, freq_idx, power) with each partition's own window and buffer; in sample
    deviations within session, partition, pair and frequency if p says so. events: with event_id, eegfile and eegoffset."""
    out = None
    classes = masks.partitions(events)
    for name, (start, end, buffer) in p.windows.items():
        own = events.where(classes[name])
        # the buffer is recorded signal on both sides, which is cut off after the transform
        wide = cut_epochs(own, chunks, round(1000 * (start - buffer)), round(1000 * (end + buffer)))
        rows = own.select(*session_keys, "event_id").join(wide, "event_id")
        keys = [*dict.fromkeys([*session_keys, "event_id", "pair_idx"])]
        got = powers(rows, keys, p.frequencies, p.width, buffer, p.log_powers, recorded=True).withColumn("partition", F.lit(name))
        out = got if out is None else out.unionByName(got)
    if not p.normalize_powers:
        return out
    return out.withColumn("power", sequence.zscore(out, [*session_keys, "partition", "pair_idx", "freq_idx"], "power"))


def slepian(n: int, half_bandwidth: float, count: int) -> np.ndarray:
    """The first discrete prolate sequences of length n: eigenvectors of the tridiagonal matrix that commutes with the
    concentration problem."""
    w = half_bandwidth / n
    i = np.arange(n)
    diagonal = ((n - 1 - 2 * i) / 2) ** 2 * np.cos(2 * np.pi * w)
    off = i[1:] * (n - i[1:]) / 2
    _, vectors = np.linalg.eigh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    return vectors[:, ::-1][:, :count].T


def multitaper_psd(epochs: DataFrame, keys: list[str], low: float = 5.0, high: float = 8.0, half_bandwidth: float = 2.0) -> DataFrame:
    """(keys, power): the mean base-10 logarithm of the multitaper spectrum from low to high hertz."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own, x in by_length(frame):
                rate, n = float(own["samplerate"].iloc[0]), x.shape[1]
                tapers = slepian(n, half_bandwidth, max(1, int(2 * half_bandwidth) - 1))
                spectra = np.abs(np.fft.rfft(x[:, None, :] * tapers[None], axis=2)) ** 2
                f = np.fft.rfftfreq(n, 1 / rate)
                band = (f >= low) & (f <= high)
                value = np.log10(spectra.mean(axis=1)[:, band] / rate + EPSILON).mean(axis=1) if band.any() else np.full(len(own), np.nan)
                yield own[keys].assign(power=value)

    types = dict(epochs.dtypes)
    return epochs.select(*keys, "samples", "samplerate").mapInPandas(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "power double"]))


def spectra(epochs: DataFrame, keys: list[str], low: float, high: float) -> DataFrame:
    """(keys, bin, re, im): the bins of each epoch's windowed spectrum from low to high hertz."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own, x in by_length(frame):
                rate, n = float(own["samplerate"].iloc[0]), x.shape[1]
                z = np.fft.rfft((x - x.mean(axis=1, keepdims=True)) * np.hanning(n), axis=1)
                f = np.fft.rfftfreq(n, 1 / rate)
                at = np.flatnonzero((f >= low) & (f <= high))
                out = own[keys].loc[own.index.repeat(len(at))].reset_index(drop=True)
                yield out.assign(bin=np.tile(at, len(own)).astype(np.int32), re=z[:, at].real.reshape(-1), im=z[:, at].imag.reshape(-1))

    types = dict(epochs.dtypes)
    return epochs.select(*keys, "samples", "samplerate").mapInPandas(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "bin int, re double, im double"]))


def coherence(epochs: DataFrame, group: list[str], low: float = 4.0, high: float = 13.0) -> DataFrame:
    """(group, i, j, coherence) for pairs i < j: |sum Sxy| / sqrt(sum Sxx sum Syy) over a group's events, averaged over the
    band's bins. Auto-spectra are summed once for each pair, and cross-spectra within an event and bin by an equi-join."""
    s = spectra(epochs, [*group, "event_id", "pair_idx"], low, high)
    auto = s.groupBy(*group, "pair_idx", "bin").agg(F.sum(F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("p"))
    side = lambda n: s.select(*group, "event_id", "bin", F.col("pair_idx").alias(n), F.col("re").alias(f"{n}r"), F.col("im").alias(f"{n}m"))
    both = side("i").join(side("j"), [*group, "event_id", "bin"]).where("i < j")
    cross = both.groupBy(*group, "bin", "i", "j").agg(F.sum(F.col("ir") * F.col("jr") + F.col("im") * F.col("jm")).alias("a"), F.sum(F.col("im") * F.col("jr") - F.col("ir") * F.col("jm")).alias("b"))
    power = lambda n: auto.select(*group, "bin", F.col("pair_idx").alias(n), F.col("p").alias(f"p{n}"))
    rows = cross.join(power("i"), [*group, "bin", "i"]).join(power("j"), [*group, "bin", "j"])
    value = F.try_divide(F.sqrt(F.col("a") * F.col("a") + F.col("b") * F.col("b")), F.sqrt(F.col("pi") * F.col("pj")))
    return rows.groupBy(*group, "i", "j").agg(F.avg(value).alias("coherence"))


def by_priority(sessions: DataFrame, experiments: tuple[str, ...] = ("FR1", "catFR1", "LocationSearch", "RepFR1")) -> DataFrame:
    """Each subject's sessions of the first experiment, in this order, that it has any of."""
    rank = F.array_position(F.array(*map(F.lit, experiments)), F.col("experiment"))
    rows = sessions.where(rank > 0).withColumn("_r", rank)
    return rows.withColumn("_b", F.min("_r").over(Window.partitionBy("subject"))).where("_r = _b").drop("_r", "_b")


def as_rows(matrix: DataFrame, column: str, n_frequencies: int) -> DataFrame:
    """An array of a row's features as (pair_idx, freq_idx, power) rows."""
    rows = matrix.select(*[c for c in matrix.columns if c != column], F.posexplode(column).alias("_i", "power"))
    return rows.withColumns({"pair_idx": F.floor(F.col("_i") / n_frequencies).cast("int"), "freq_idx": F.col("_i") % n_frequencies}).drop("_i")


def as_arrays(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The inverse of ``as_rows``: one array for each event, in order of pair and frequency."""
    got = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pair_idx", "freq_idx", "power"))).alias("_v"))
    return got.select(*keys, F.transform("_v", lambda v: v["power"]).alias("features"))


def cut_epochs(events: DataFrame, chunks: DataFrame, start_ms: int, stop_ms: int) -> DataFrame:
    """(event_id, pair_idx, samplerate, samples) of [eegoffset + start, eegoffset + stop) around each event. chunks: (eegfile,
    pair_idx, samplerate, chunk_id, samples) of equal length ``chunk_len``; an event touches a few chunks, so the join is on
    file and chunk number. Events whose window isn't wholly recorded give no row."""
    rate = F.col("samplerate")
    first = F.col("eegoffset") + F.floor(F.lit(start_ms) * rate / 1000)
    size = F.floor(F.lit(stop_ms - start_ms) * rate / 1000)
    files = chunks.groupBy("eegfile").agg(F.max("samplerate").alias("samplerate"), F.max(F.size("samples")).alias("chunk_len"))
    windows = events.join(files, "eegfile").select("event_id", "eegfile", "chunk_len", first.cast("long").alias("_a"), size.cast("long").alias("_n")).where("_a >= 0 AND _n > 0")
    touched = windows.withColumn("chunk_id", F.explode(F.sequence(F.floor(F.col("_a") / F.col("chunk_len")), F.floor((F.col("_a") + F.col("_n") - 1) / F.col("chunk_len")))))
    parts = touched.join(chunks.select("eegfile", "pair_idx", "samplerate", F.col("chunk_id").cast("long").alias("chunk_id"), "samples"), ["eegfile", "chunk_id"])
    begin = F.greatest(F.col("_a") - F.col("chunk_id") * F.col("chunk_len"), F.lit(0))
    end = F.least(F.col("_a") + F.col("_n") - F.col("chunk_id") * F.col("chunk_len"), F.size("samples").cast("long"))
    piece = F.slice("samples", (begin + 1).cast("int"), F.greatest(end - begin, F.lit(0)).cast("int"))
    got = parts.groupBy("event_id", "pair_idx", "samplerate", "_n").agg(F.sort_array(F.collect_list(F.struct("chunk_id", piece.alias("s")))).alias("_p"))
    whole = got.select("event_id", "pair_idx", "samplerate", "_n", F.flatten(F.transform("_p", lambda p: p["s"])).alias("samples"))
    return whole.where(F.size("samples") == F.col("_n")).drop("_n")


def invalid_as_null(epochs: DataFrame, bad_events: DataFrame, bad_pairs: DataFrame) -> DataFrame:
    """Samples of bad events and pairs as null."""
    e = bad_events.select("event_id", F.lit(True).alias("_e")).distinct()
    p = bad_pairs.select("pair_idx", F.lit(True).alias("_p")).distinct()
    rows = epochs.join(e, "event_id", "left").join(p, "pair_idx", "left")
    return rows.withColumn("samples", F.when(F.col("_e").isNull() & F.col("_p").isNull(), F.col("samples"))).drop("_e", "_p")


def sample_rate_of(epochs: DataFrame, keys: list[str]) -> DataFrame:
    return epochs.groupBy(*keys).agg(F.first("samplerate").alias("samplerate"))


def resampled(epochs: DataFrame, keys: list[str], rate: float = 256.0, low: float = 58.0, high: float = 62.0) -> DataFrame:
    """(keys, samplerate, samples): epochs without the band from low to high, at another rate by cutting or filling the
    spectrum."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own, x in by_length(frame):
                old = float(own["samplerate"].iloc[0])
                n = max(1, round(x.shape[1] * rate / old))
                spectrum = np.fft.rfft(band_stop(x, old, low, high), axis=1)
                new = np.zeros((len(x), n // 2 + 1), complex)
                k = min(new.shape[1], spectrum.shape[1])
                new[:, :k] = spectrum[:, :k]
                yield own[keys].assign(samplerate=rate, samples=list(np.fft.irfft(new, n, axis=1) * (n / x.shape[1])))

    types = dict(epochs.dtypes)
    return epochs.select(*keys, "samples", "samplerate").mapInPandas(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "samplerate double, samples array<double>"]))


def stim_epochs(events: DataFrame, chunks: DataFrame, after: bool, buffer: int = 50, window: int = 900, duration: int = 500) -> DataFrame:
    """Epochs of ``window`` milliseconds that end ``buffer`` before stimulation, or begin ``buffer`` after its end."""
    return cut_epochs(events, chunks, duration + buffer, duration + buffer + window) if after else cut_epochs(events, chunks, -(buffer + window), -buffer)


def bad_events(epochs: DataFrame, events: DataFrame, keys: list[str], order: list[str], least_ms: int = 1500) -> DataFrame:
    """event_id and bad: adjacent to another event, or saturated on a pair. (event_id, pair) rows of saturation come along as
    ``bad`` of ``bad_pairs`` by behavior.bad_channels."""
    flat = epochs.groupBy("event_id").agg(F.bool_or(sequence.saturated(F.col("samples"))).alias("_s"))
    rows = sequence.adjacent(events, keys, order, least_ms).join(flat, "event_id", "left")
    return rows.select("event_id", (F.col("adjacent") | F.coalesce("_s", F.lit(False))).alias("bad"))


def psd_pair(before: DataFrame, after: DataFrame) -> DataFrame:
    """(event_id, pair_idx, pre, post): multitaper power of epochs before and after stimulation."""
    keys = ["event_id", "pair_idx"]
    return multitaper_psd(before, keys).withColumnRenamed("power", "pre").join(multitaper_psd(after, keys).withColumnRenamed("power", "post"), keys)


def common_average(epochs: DataFrame, keys: list[str] | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """epochs with the mean over an event's channels taken from each sample; keys: what an event is (event_id, unless told).

    Sums of samples are made in Arrow batches first, a row for each event that a batch has, and those are added up: no event's
    epochs need to meet in one row or task. Channels of ``excluded`` (pair_idx, and keys if they are bad for an event alone)
    don't count in the mean but are referenced, too. Null samples stay null and don't count; epochs of an event that differ in
    length are averaged by length; an event without a channel that counts keeps its samples."""
    keys = ["event_id"] if keys is None else keys
    sized = epochs.withColumn("_n", F.size("samples"))
    by = [*keys, "_n"]
    counted = sized.where(F.col("samples").isNotNull())
    if excluded is not None:
        counted = counted.join(excluded, [c for c in excluded.columns if c in epochs.columns], "left_anti")

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for length, same in frame.groupby("_n", sort=False):
                if not length:
                    continue
                code, names = pd.factorize(pd.MultiIndex.from_frame(same[keys]))
                total = np.zeros((len(names), length))
                np.add.at(total, code, np.stack(same["samples"].to_numpy()).astype(np.float64))
                yield pd.DataFrame(list(names), columns=keys).assign(_n=length, _k=np.bincount(code), _s=list(total))

    types = dict(epochs.dtypes)
    shape = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "_n int, _k long, _s array<double>"])
    parts = counted.select(*by, "samples").mapInPandas(sums, shape).groupBy(*by).agg(F.sum("_k").alias("_k"), F.collect_list("_s").alias("_p"))
    zero = F.transform(F.get("_p", F.lit(0)), lambda x: F.lit(0.0))
    mean = F.transform(F.aggregate("_p", zero, lambda acc, x: F.zip_with(acc, x, lambda p, q: p + q)), lambda x: x / F.col("_k"))
    rows = sized.join(parts.select(*by, mean.alias("_m")), by, "left")
    return rows.withColumn("samples", F.when(F.col("_m").isNull(), F.col("samples")).otherwise(F.zip_with("samples", "_m", lambda x, m: x - m))).select(*epochs.columns)
