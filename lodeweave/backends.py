"""Speech models as pluggable parts: made once in each Python worker, called for each attempt.

A ``Backend`` holds factories, not models, so it can be sent to executors. ``tone_backend`` needs no model: it is
for tests and trial runs.
"""

from __future__ import annotations

import hashlib
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeweave.functions import audio, ids

Speaker = Callable[[str, str, int], tuple[object, int]]
Listener = Callable[[str, str], str]
_FATAL = ("cublas", "cuda", "cudnn", "device-side assert", "out of memory")
_MADE: dict[str, object] = {}
_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
GENERATED = "pair_id string, language string, attempt int, seed bigint, generation_status string, generation_error string, wav_native string, wav_16k string, duration double, sha256 string, tts_seconds double"
HEARD = "pair_id string, language string, attempt int, asr_text string, asr_seconds double, asr_error string"


def _batch(rows: list[dict[str, object]], fields: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, _TYPES[t]) for n, t in (f.split() for f in fields.split(", "))]))


@dataclass(frozen=True)
class Backend:
    """speaker() gives (text, language, seed) -> (samples, rate); listener() gives (file, language) -> text."""

    name: str
    speaker: Callable[[], Speaker]
    listener: Callable[[], Listener]
    reader: Callable[..., str]
    tokenizer: object | None = None
    #: What records say of the models; None: the settings' models, which such a backend must load.
    facts: dict[str, str] | None = None
    #: Whether it needs the accelerator that the settings ask for.
    accelerated: bool = True


_DTYPES = ("bfloat16", "float16", "float32")


def dtype(name: str) -> object:
    """The library's type of a name in the settings; ValueError for one that no model here is loaded with."""
    if name not in _DTYPES:
        raise ValueError(f"{name!r} is none of {', '.join(_DTYPES)}")
    import torch

    return getattr(torch, name)


def fatal(error: BaseException) -> bool:
    """Whether a worker can't go on after an error: the accelerator is lost or full."""
    return isinstance(error, RuntimeError) and any(m in str(error).lower() for m in _FATAL)


def seeded(seed: int) -> None:
    """Seed what random numbers models may draw from."""
    random.seed(seed)
    np.random.seed(seed % 2**32)
    try:
        import torch
    except ModuleNotFoundError:
        return
    torch.manual_seed(seed)
    if torch.cuda.is_available():
        torch.cuda.manual_seed_all(seed)


def _made(key: str, factory: Callable[[], object]) -> object:
    if key not in _MADE:
        _MADE.clear()  # one model at a time
        _MADE[key] = factory()
    return _MADE[key]


def generated(targets: DataFrame, backend: Backend, folder: str, shards: int, rate: int, least: float, most: float, resume: bool = True, native: bool = False) -> DataFrame:
    """An attempt for each row (pair_id, language, attempt, shard, text): a file in ``folder``, which executors share.

    A file that is there and of allowed length is used again if ``resume``. An error fails the attempt, a fatal one the
    task. Attempts have seeds of their own, so that a task that runs again makes the same.
    """

    def speak(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in map(lambda x: SimpleNamespace(**x), batch.to_pylist()):
                began = time.perf_counter()
                place = Path(folder) / "audio" / "16k" / r.language / r.shard_name / r.file
                own = Path(folder) / "audio" / "native" / r.language / r.shard_name / r.file if native else None
                row = {"pair_id": r.pair_id, "language": r.language, "attempt": r.attempt, "seed": r.seed}
                try:
                    seconds = audio.header_seconds(place.read_bytes()) if resume and place.is_file() else None
                    if seconds is None or not least <= seconds <= most:
                        seeded(r.seed)
                        samples, have = _made(f"{backend.name} speaker", backend.speaker)(r.text, r.language, r.seed)
                        if own:
                            audio.write_wav(own, samples, have)
                        audio.write_wav(place, audio.resampled(samples, have, rate), rate)
                    data = place.read_bytes()
                    row |= {"generation_status": "ok", "wav_native": str(own) if own and own.is_file() else None, "wav_16k": str(place), "duration": audio.header_seconds(data), "sha256": hashlib.sha256(data).hexdigest()}
                except Exception as e:
                    if fatal(e):
                        raise
                    row |= {"generation_status": "failed", "generation_error": f"{type(e).__name__}: {e}"}
                out.append(row | {"tts_seconds": round(time.perf_counter() - began, 3)})
            yield _batch(out, GENERATED)

    rows = targets.select("pair_id", "language", "attempt", "text", ids.seed(F.col("pair_id"), F.col("language"), F.col("attempt")).alias("seed"), ids.shard_name(F.col("shard"), shards).alias("shard_name"), ids.audio_name(F.col("pair_id"), F.col("attempt")).alias("file"))
    return rows.mapInArrow(speak, GENERATED)


def heard(attempts: DataFrame, backend: Backend) -> DataFrame:
    """The transcript of each generated attempt (pair_id, language, attempt, wav_16k), or the error."""

    def listen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in map(lambda x: SimpleNamespace(**x), batch.to_pylist()):
                began, text, error = time.perf_counter(), None, None
                try:
                    text = _made(f"{backend.name} listener", backend.listener)(r.wav_16k, r.language).strip()
                except Exception as e:
                    if fatal(e):
                        raise
                    error = f"{type(e).__name__}: {e}"
                out.append({"pair_id": r.pair_id, "language": r.language, "attempt": r.attempt, "asr_text": text, "asr_seconds": round(time.perf_counter() - began, 3), "asr_error": error})
            yield _batch(out, HEARD)

    return attempts.where("generation_status = 'ok'").select("pair_id", "language", "attempt", "wav_16k").mapInArrow(listen, HEARD)


def tone_backend(fail: Callable[[str, int], bool] = lambda text, seed: False) -> Backend:
    """Speech as a tone with the text beside it in a file; ``fail`` says which attempts are misheard."""

    def speaker() -> Speaker:
        def speak(text: str, language: str, seed: int) -> tuple[object, int]:
            if "!error" in text:
                raise ValueError("can't say that")
            n = max(12000, min(24000, 600 * len(text)))
            x = 0.1 * np.sin(np.arange(n) * 0.1)
            code = np.frombuffer(("\0misheard" if fail(text, seed) else text).encode(), np.uint8)
            # the text is in the first samples, in steps that survive a 16-bit file of the same rate
            x[: 2 * len(code) : 2] = 0
            x[1 : 2 * len(code) : 2] = (code.astype(np.float64) + 1) / 512
            return x[: max(n, 2 * len(code))], 16000

        return speak

    def listener() -> Listener:
        def listen(file: str, language: str) -> str:
            import wave

            with wave.open(file) as w:
                x = np.frombuffer(w.readframes(w.getnframes()), "<i2")
            code = []
            for k in range(1, len(x), 2):
                c = round(x[k] / 32767 * 512) - 1
                if x[k - 1] != 0 or c < 0:
                    break
                code.append(c)
            return bytes(code).decode(errors="replace").replace("\0", "")

        return listen

    made_up = dict.fromkeys(("tts_model_id", "tts_model_revision", "tts_speaker_id", "tts_dtype", "qc_asr_model_id", "qc_asr_model_revision"), "tone")
    return Backend("tone", speaker, listener, lambda text, kana=True: text, facts=made_up, accelerated=False)
