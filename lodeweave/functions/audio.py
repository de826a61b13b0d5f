"""Waveforms: checks, resampling, PCM files and their headers. Stdlib and numpy; a better resampler can be passed in."""

from __future__ import annotations

import io
import os
import tempfile
import wave
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Resampler = Callable[[np.ndarray, int, int], np.ndarray]


def mono(samples: object) -> np.ndarray:
    """One channel of 32-bit floats; ValueError for several channels or numbers that aren't finite."""
    x = np.squeeze(np.asarray(samples, dtype=np.float32))
    if x.ndim != 1:
        raise ValueError(f"not one channel: {x.shape}")
    if not np.isfinite(x).all():
        raise ValueError("not all samples are finite")
    return np.ascontiguousarray(x)


def windowed_sinc(x: np.ndarray, have: int, want: int, half: int = 32) -> np.ndarray:
    """Band-limited interpolation by a Hann-windowed sinc."""
    n = int(np.ceil(len(x) * want / have))
    at = np.arange(n) * (have / want)
    cut = min(1.0, want / have)
    reach = int(np.ceil(half / cut))
    padded = np.concatenate([np.zeros(reach, np.float64), x, np.zeros(reach + 1, np.float64)])
    out = np.zeros(n)
    base = np.floor(at).astype(np.int64)
    for k in range(-reach + 1, reach + 1):
        off = at - (base + k)
        w = np.where(np.abs(off) < reach, 0.5 + 0.5 * np.cos(np.pi * off / reach), 0.0)
        out += padded[base + k + reach] * cut * np.sinc(cut * off) * w
    return out


def resampled(samples: object, have: int, want: int, by: Resampler = windowed_sinc) -> np.ndarray:
    """Another sample rate; the same samples if it is the same."""
    x = mono(samples)
    return x if have == want else mono(by(x, have, want))


def pcm16(samples: object, rate: int) -> bytes:
    """A 16-bit WAV file in memory; samples beyond one are clipped."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.clip(np.rint(mono(samples) * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def write_wav(path: Path, samples: object, rate: int) -> None:
    """Under a temporary name, flushed to disk, then renamed, so a file of that name is whole."""
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(suffix=".part.wav", dir=path.parent)
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(pcm16(samples, rate))
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    finally:
        Path(name).unlink(missing_ok=True)


def header_seconds(content: bytes) -> float | None:
    """Frames over rate; None for what is no WAV file."""
    try:
        with wave.open(io.BytesIO(content)) as w:
            return w.getnframes() / w.getframerate()
    except (wave.Error, EOFError, ZeroDivisionError):
        return None


@F.pandas_udf(T.DoubleType())
def wav_seconds(content: pd.Series) -> pd.Series:
    """Seconds of WAV files in a binary column; null for what is none."""
    return content.map(lambda b: None if b is None else header_seconds(b)).astype("float64")


def usable(files: DataFrame, least: float, most: float) -> DataFrame:
    """(path, seconds) of audio files with a length within the closed range, from a binaryFile scan."""
    return files.select("path", wav_seconds("content").alias("seconds")).where(F.col("seconds").between(least, most))
