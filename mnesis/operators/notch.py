"""Recordings without a band, by a recursive Butterworth band-stop run forward and backward over chunks of any length.

Within a chunk the filter's output is that of its samples alone plus that of the state that it began with, and its last
state is a matrix times the state that it began with plus that of its samples alone. So chunks are filtered apart: each
gives its own last state (eight numbers for order 4), a scan over a channel's chunks, which are some thousand rows of
eight numbers, gives the state that each begins with, and the chunks' outputs follow. The same, from the last chunk to the
first and in reversed time, makes the phase zero. No recording or channel meets in a row or task.

Conventions: order 4, 58 to 62 hertz unless told; a channel begins as if its first sample (its last, backward) had always
been; a missing chunk ends a recording, and what follows begins anew. Null or empty chunks are left out. Chunks of a
channel may differ in length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnesis.sources import scratch

CHANNEL = ["eegfile", "pair_idx"]


def sections(low: float, high: float, rate: float, order: int = 4) -> list[tuple[np.ndarray, np.ndarray]]:
    """Second-order sections (b, a) of a Butterworth band-stop, each with gain 1 at 0 hertz: the prototype's poles go to the
    band by s -> width s / (s^2 + centre^2), and to z by the bilinear rule."""
    w1, w2 = (2 * rate * np.tan(np.pi * f / rate) for f in (low, high))
    width, centre = w2 - w1, np.sqrt(w1 * w2)
    prototype = np.exp(1j * np.pi * (2 * np.arange(1, order + 1) + order - 1) / (2 * order))
    poles = np.concatenate([np.roots([1, -width / p, centre**2]) for p in prototype])
    z = (2 * rate + poles) / (2 * rate - poles)
    zero = (2 * rate + 1j * centre) / (2 * rate - 1j * centre)
    b0 = np.array([1.0, -2 * zero.real, 1.0])
    out = []
    for p in sorted(z[z.imag > 0], key=lambda p: (abs(p), p.real)):
        a = np.array([1.0, -2 * p.real, abs(p) ** 2])
        out.append((b0 * a.sum() / b0.sum(), a))
    return out


@lru_cache(maxsize=32)
def system(low: float, high: float, rate: float, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, np.ndarray]:
    """(A, B, C, D, rest): the sections in a row as one system of states, x' = A x + B u and y = C x + D u, and the state in
    which a constant 1 leaves it."""
    a, b, c, d = np.zeros((0, 0)), np.zeros(0), np.zeros(0), 1.0
    for num, den in sections(low, high, rate, order):
        own_a = np.array([[-den[1], 1.0], [-den[2], 0.0]])
        own_b, own_c = num[1:] - den[1:] * num[0], np.array([1.0, 0.0])
        n = len(b)
        a = np.block([[a, np.zeros((n, 2))], [np.outer(own_b, c), own_a]])
        b, c, d = np.concatenate((b, own_b * d)), np.concatenate((num[0] * c, own_c)), num[0] * d
    return a, b, c, d, np.linalg.solve(np.eye(len(b)) - a, b)


@lru_cache(maxsize=64)
def block(low: float, high: float, rate: float, order: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of n samples: the response to a single 1, the outputs of each state by sample, the samples' parts in the last state,
    and what becomes of the first state."""
    a, b, c, d, _ = system(low, high, rate, order)
    free, reach = np.empty((n, len(b))), np.empty((n, len(b)))
    row, column = c.copy(), b.copy()
    for t in range(n):
        free[t], reach[n - 1 - t] = row, column
        row, column = row @ a, a @ column
    impulse = np.concatenate(([d], free[: n - 1] @ b))
    return impulse, free, reach, np.linalg.matrix_power(a, n)


def _by_length(frame: pd.DataFrame, backward: bool) -> Iterator[tuple[pd.DataFrame, np.ndarray, float]]:
    for (rate, _), own in frame.groupby(["samplerate", frame["samples"].map(len)], sort=False):
        x = np.stack(own["samples"].to_numpy()).astype(np.float64)
        yield own, x[:, ::-1] if backward else x, float(rate)


def one_way(chunks: DataFrame, low: float, high: float, order: int, backward: bool) -> DataFrame:
    """The chunks filtered in one direction of time."""
    types = dict(chunks.dtypes)
    keys = ", ".join(f"`{k}` {types[k]}" for k in (*CHANNEL, "chunk_id"))

    def ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own, x, rate in _by_length(frame, backward):
                last = x @ block(low, high, rate, order, x.shape[1])[2]
                yield own[[*CHANNEL, "chunk_id", "samplerate"]].assign(n=x.shape[1], first=x[:, 0], last=list(last))

    def scan(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("chunk_id", ascending=not backward)
        states, state, before = [], None, None
        for number, rate, n, first, last in zip(own["chunk_id"], own["samplerate"], own["n"], own["first"], own["last"], strict=True):
            if before is None or abs(number - before) != 1:
                state = system(low, high, float(rate), order)[4] * first
            states.append(state.tolist())
            state, before = block(low, high, float(rate), order, int(n))[3] @ state + last, number
        return own[[*CHANNEL, "chunk_id"]].assign(state=states)

    def outputs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own, x, rate in _by_length(frame, backward):
                n = x.shape[1]
                impulse, free, _, _ = block(low, high, rate, order, n)
                size = 2 * n
                y = np.fft.irfft(np.fft.rfft(x, size, axis=1) * np.fft.rfft(impulse, size), size, axis=1)[:, :n]
                y += np.stack(own["state"].to_numpy()) @ free.T
                yield own[[*CHANNEL, "chunk_id", "samplerate"]].assign(samples=list(y[:, ::-1] if backward else y))

    rows = chunks.where(F.size("samples") > 0).select(*CHANNEL, "chunk_id", F.col("samplerate").cast("double").alias("samplerate"), F.col("samples").cast("array<double>").alias("samples"))
    finals = rows.mapInPandas(ends, f"{keys}, samplerate double, n int, first double, last array<double>")
    states = finals.groupBy(*CHANNEL).applyInPandas(scan, f"{keys}, state array<double>")
    return rows.join(states, [*CHANNEL, "chunk_id"]).mapInPandas(outputs, f"{keys}, samplerate double, samples array<double>")


def without_band(chunks: DataFrame, low: float = 58.0, high: float = 62.0, order: int = 4) -> DataFrame:
    """chunks (eegfile, pair_idx, samplerate, chunk_id, samples) without the band, phase unchanged. The forward pass is
    written to the scratch folder, as the backward pass reads it twice."""
    path = scratch.folder(chunks.sparkSession, "forward")
    one_way(chunks, low, high, order, backward=False).write.parquet(path)
    return one_way(chunks.sparkSession.read.parquet(path), low, high, order, backward=True).select("eegfile", "pair_idx", "samplerate", "chunk_id", "samples")
