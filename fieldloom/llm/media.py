"""Media columns: bytes kept as WAV, read back by the wave module, and fingerprinted by pairs of spectral peaks.

A text's UTF-8 bytes, padded with 255 up to a positive multiple of 576, are the samples of an 8-bit mono WAV. The stored
bytes are opened again and their frames analysed: short-time Fourier transforms of 576 samples (Hann window, half
overlap), the strongest bin in each of four bands, and pairs of peaks of neighbouring bands in a frame and its next.
A pair is one long: time << 20 | bin << 11 | other bin << 2 | frames between.

Defined results: null counts as empty (one block of padding). Texts of any length are taken whole; frames are analysed
in blocks, so memory beyond the payload itself doesn't grow with the text. Equal texts have equal values; of bins of
equal power (ties) the lowest is the peak. Every row, repeated ones too, gives a row; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import stream

BLOCK, HOP, RATE = 576, 288, 8000
#: First bins of the bands; the last entry ends the last band.
BANDS = (1, 12, 36, 96, 289)
_WINDOW = np.hanning(BLOCK).astype(np.float32)
#: (band, other band, frames between).
PAIRS = ((0, 1, 0), (2, 3, 0), (0, 2, 1), (1, 3, 1))


def padded(data: bytes) -> bytes:
    return data + b"\xff" * (max(BLOCK, -(-len(data) // BLOCK) * BLOCK) - len(data))


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media)) as w:
        return w.readframes(w.getnframes())


def peaks(samples: np.ndarray, at_once: int = 1024) -> np.ndarray:
    """The strongest bin of each band: frames x bands."""
    frames = np.lib.stride_tricks.sliding_window_view(samples, BLOCK)[::HOP]
    out = np.empty((len(frames), len(BANDS) - 1), np.int64)
    for at in range(0, len(frames), at_once):
        part = frames[at : at + at_once].astype(np.float32) - np.float32(128)
        spectrum = np.fft.rfft(part * _WINDOW, axis=1)
        power = spectrum.real**2 + spectrum.imag**2
        for b in range(len(BANDS) - 1):
            out[at : at + at_once, b] = BANDS[b] + power[:, BANDS[b] : BANDS[b + 1]].argmax(axis=1)
    return out


def fingerprints(payload: bytes) -> np.ndarray:
    found = peaks(np.frombuffer(payload, np.uint8))
    time, out = np.arange(len(found), dtype=np.int64), []
    for a, b, later in PAIRS:
        n = len(found) - later
        out.append(time[:n] << 20 | found[:n, a] << 11 | found[later:, b] << 2 | later)
    return np.sort(np.concatenate(out))


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_media: bool = True) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, fingerprints and, if asked for, media (the WAV)."""

    def rows(parts: Iterator[dict]) -> Iterator[dict]:
        names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "fingerprints", *["media"] * with_media)
        for part in parts:
            for at in range(0, len(part[id_col]), 32):  # the media of a few rows at a time
                out: dict = {"doc_id": part[id_col][at : at + 32]} | {n: [] for n in names}
                for text in part[text_col][at : at + 32]:
                    data = (text or "").encode()
                    media = to_wav(padded(data))
                    read = from_wav(media)
                    pairs = fingerprints(read)
                    feature = f"{len(read) // HOP - 1}:{len(pairs)}:{hashlib.blake2b(pairs.tobytes(), digest_size=16).hexdigest()}"
                    values = (len(data), len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, pairs, media)
                    for n, v in zip(names, values, strict=False):
                        out[n].append(v)
                yield out

    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, fingerprints array<bigint>" + ", media binary" * with_media
    return stream(docs, [id_col, text_col], schema, rows)
