"""Telephony audio in a media column: mu-law, A-law and IMA ADPCM, to resampled PCM.

A medium is a WAV file of one channel at 8000 samples a second whose data chunk is the payload as it is: 8-bit codes for
mu-law and A-law, blocks of ``block`` bytes for ADPCM. The codes of the two laws are expanded by tables of 256 values.
ADPCM keeps its state within a block, so the blocks of many media are decoded at once: numpy steps through the samples
of a block, over all blocks in parallel. PCM is stored at a rate of 16000 or 4000: twice the rate keeps the samples and sets
between two of them the value of a half-band filter of eight taps; half the rate takes the mean of two neighbours.

``round_trip`` writes media and then PCM to tables in the shared folder and takes its results from what it reads back.

Defined results: a null payload is empty; an empty medium has no samples and zero features; repeated rows get equal
media; a text of any length is one medium; ADPCM needs a multiple of the block, and a payload that isn't one raises
ValueError; other columns, whatever their names, are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnesis.llm.common import settled, slices

RATE = 8000
#: The format tags of WAV.
FORMATS = {"alaw": 6, "mulaw": 7, "adpcm": 17}
#: How an IMA ADPCM code moves the step index.
INDEX_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)
#: The taps of the half-band filter, for the middle of eight samples.
TAPS = np.array([-5, 49, -245, 1225, 1225, -245, 49, -5]) / 2048


#: The 89 step sizes of IMA ADPCM.
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
    1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484,
    7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.uint8)
    size = (((code & 15).astype(np.int32) << 3) + 132 << ((code >> 4) & 7).astype(np.int32)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.uint8) ^ 0x55
    part, mantissa = ((code >> 4) & 7).astype(np.int32), (code & 15).astype(np.int32)
    size = np.where(part == 0, (mantissa << 4) + 8, ((mantissa << 4) + 264) << np.maximum(part - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


def wav(payload: bytes, codec: str, block: int = 192) -> bytes:
    """A WAV file whose data chunk is the payload."""
    align, bits = (block, 4) if codec == "adpcm" else (1, 8)
    per_block = 2 * (block - 4) + 1 if codec == "adpcm" else 1
    extra = struct.pack("<HH", 2, per_block) if codec == "adpcm" else struct.pack("<H", 0)
    head = struct.pack("<HHIIHH", FORMATS[codec], 1, RATE, RATE * align // per_block, align, bits) + extra
    samples = struct.pack("<I", len(payload) // align * per_block)
    pad = b"\0" * (len(payload) % 2)
    body = b"WAVE" + b"".join(k + struct.pack("<I", len(v)) + v for k, v in ((b"fmt ", head), (b"fact", samples))) + b"data" + struct.pack("<I", len(payload)) + payload + pad
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> tuple[str, int, bytes]:
    """Codec, block and payload of a WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, codec, block = 12, "", 0
    while at + 8 <= len(media):
        name, (size,) = media[at : at + 4], struct.unpack("<I", media[at + 4 : at + 8])
        if name == b"fmt ":
            tag, _, _, _, block, _ = struct.unpack("<HHIIHH", media[at + 8 : at + 24])
            codec = next(k for k, v in FORMATS.items() if v == tag)
        elif name == b"data":
            return codec, block, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """blocks: (n, block) bytes; the 16-bit samples of each, 2 * (block - 4) + 1 a row."""
    n, block = blocks.shape
    steps = STEPS
    value = blocks[:, 0].astype(np.int32) | blocks[:, 1].astype(np.int32) << 8
    value = np.where(value >= 32768, value - 65536, value).astype(np.int32)
    index = np.minimum(blocks[:, 2], len(steps) - 1).astype(np.int32)
    out = np.empty((2 * (block - 4) + 1, n), np.int16)
    out[0] = value
    columns = np.ascontiguousarray(blocks[:, 4:].T)
    for k in range(2 * (block - 4)):
        code = (columns[k >> 1] >> (4 * (k & 1))) & 15
        step, size = steps[index], (code & 7).astype(np.int32)
        move = (step >> 3) + np.where(size & 4, step, 0) + np.where(size & 2, step >> 1, 0) + np.where(size & 1, step >> 2, 0)
        value = np.clip(np.where(code & 8, value - move, value + move), -32768, 32767)
        index = np.clip(index + INDEX_MOVES[size], 0, len(steps) - 1)
        out[k + 1] = value
    return out.T


def doubled(samples: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Samples of several media in a row at twice the rate; bounds: where each medium's samples start and end. Beyond a
    medium's ends there is silence."""
    size, gap = np.diff(bounds), len(TAPS)
    place = np.arange(len(samples)) + gap * np.repeat(np.arange(1, len(size) + 1), size)
    wide = np.zeros(len(samples) + gap * (len(size) + 1), np.float32)
    wide[place] = samples
    between = np.zeros(len(wide) - gap + 1, np.float32)
    for j, tap in enumerate(TAPS.astype(np.float32)):
        between += tap * wide[j : j + len(between)]
    out = np.empty(2 * len(samples), np.int16)
    out[0::2] = samples
    out[1::2] = np.clip(np.rint(between[place - gap // 2 + 1]), -32768, 32767)
    return out


def halved(samples: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Samples of several media in a row at half the rate, of each an even number."""
    if (np.diff(bounds) % 2).any():
        raise ValueError("an odd number of samples can't be halved")
    return ((samples[0::2].astype(np.int32) + samples[1::2]) // 2).astype(np.int16)


def pcm(payloads: list[bytes], codec: str, block: int = 192) -> tuple[np.ndarray, np.ndarray]:
    """The samples of all payloads in a row, and where each one's start and end."""
    data = np.frombuffer(b"".join(payloads), np.uint8)
    size = np.fromiter(map(len, payloads), np.int64, len(payloads))
    if codec != "adpcm":
        return (mulaw_table() if codec == "mulaw" else alaw_table())[data], np.concatenate(([0], np.cumsum(size)))
    if (size % block).any():
        raise ValueError(f"not a multiple of {block} bytes")
    samples = decode_adpcm(data.reshape(-1, block)) if len(data) else np.zeros((0, 1), np.int16)
    return samples.reshape(-1), np.concatenate(([0], np.cumsum(size // block * (2 * (block - 4) + 1))))


def features(samples: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Root mean square, number of sign changes and peak of each medium."""
    starts, size = bounds[:-1], np.diff(bounds)
    total = np.concatenate(([0], np.cumsum(samples.astype(np.int64) ** 2)))
    energy = np.sqrt((total[bounds[1:]] - total[starts]) / np.maximum(size, 1))
    turned = np.concatenate(([0], np.cumsum((samples[1:] ^ samples[:-1]) < 0), [0]))[: len(samples) + 1] if len(samples) else np.zeros(1, np.int64)
    if len(samples):
        turned[-1] = turned[len(samples) - 1]
    changes = np.where(size > 1, turned[np.maximum(bounds[1:] - 1, starts)] - turned[starts], 0)
    size_of = np.abs(samples.astype(np.int32))
    peak = [int(size_of[a:b].max()) if b > a else 0 for a, b in zip(starts, bounds[1:], strict=True)]
    return [f"rms={e:.3f},zc={n},peak={p}" for e, n, p in zip(energy, changes, peak, strict=True)]


def encode(docs: DataFrame, codec: str, unit: int = 192) -> DataFrame:
    """(doc_id, n_bytes, media): each text's bytes, filled with blanks to a positive multiple of unit, as a WAV file."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            media = [wav(t + b" " * (-len(t) % unit if t else unit), codec, unit) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    types = dict(docs.dtypes)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(store, f"doc_id {types['doc_id']}, n_bytes long, media binary")


def decode(media: DataFrame, also: tuple[str, ...] = (), rate: int = 2 * RATE) -> DataFrame:
    """doc_id, n_bytes, digests of payload and medium, feature, and the 16-bit PCM at ``rate``, twice or half that of the
    medium. also: codecs as which the payload is read besides its own, for their features."""
    kind = dict(media.dtypes)["doc_id"]
    resampled, bytes_each = {2 * RATE: (doubled, 4), RATE // 2: (halved, 1)}[rate]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "media", 1 << 19):
            stored = b.column("media").to_pylist()
            parsed = [read_wav(m) for m in stored]
            payloads = [p for _, _, p in parsed]
            own = [""] * len(parsed)
            wide: list[bytes] = [b""] * len(parsed)
            for codec, block in {(c, k) for c, k, _ in parsed}:
                at = [i for i, p in enumerate(parsed) if p[:2] == (codec, block)]
                samples, bounds = pcm([payloads[i] for i in at], codec, block)
                data = memoryview(resampled(samples, bounds).astype("<i2").tobytes())
                for k, (i, f) in enumerate(zip(at, features(samples, bounds), strict=True)):
                    own[i], wide[i] = f"{codec}:{f}", bytes(data[bytes_each * bounds[k] : bytes_each * bounds[k + 1]])
            for codec in also:
                own = [f"{x};{codec}:{f}" for x, f in zip(own, features(*pcm(payloads, codec)), strict=True)]
            columns = {
                "payload_bytes": pa.array([len(p) for p in payloads], pa.int64()),
                "payload_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
                "tail_crc32": pa.array([zlib.crc32(p[-16:]) for p in payloads], pa.int64()),
                "media_bytes": pa.array([len(m) for m in stored], pa.int64()),
                "media_sha256": pa.array([hashlib.sha256(m).hexdigest() for m in stored]),
                "feature": pa.array(own),
                "pcm": pa.array(wide, pa.binary()),
            }
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *columns.values()], ["doc_id", "n_bytes", *columns])

    return media.mapInArrow(read, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pcm binary")


def round_trip(docs: DataFrame, codec: str = "mulaw", also: tuple[str, ...] = ("alaw", "adpcm"), rate: int = 2 * RATE) -> DataFrame:
    """docs stored as media, and as PCM at ``rate``, in the shared folder, read back and described; the feature ends in the
    PCM's length and crc32."""
    media = settled(encode(docs, codec), "media", "zstd")
    read = settled(decode(media, also, rate), "pcm", "zstd")
    crc = F.lpad(F.lower(F.hex(F.crc32("pcm"))), 8, "0")
    return read.withColumn("feature", F.concat("feature", F.lit(f";pcm{rate}:bytes="), F.octet_length("pcm").cast("string"), F.lit(",crc="), crc)).drop("pcm")
