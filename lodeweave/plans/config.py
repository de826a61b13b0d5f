"""The configuration file: sections of typed settings, checked when it is read."""

from __future__ import annotations

import json
from dataclasses import field, make_dataclass, replace
from pathlib import Path
from typing import Any

_S, _I, _F, _B, _P = str, int, float, bool, Path
#: Settings of each section, by name.
SECTIONS: dict[str, dict[str, type]] = {
    "asr": {"attention": _S, "condition_on_prev_tokens": _B, "do_sample": _B, "dtype": _S, "model_id": _S, "num_beams": _I, "revision": _S},
    "device": {"attention": _S, "minimum_vram_gib": _F, "require_bf16": _B, "require_cuda": _B},
    "prepare": {
        "include_dev": _B, "include_test": _B, "ja_chars_per_second": _F, "jesc_fraction": _F, "long_time_fraction": _F, "medium_max_ja_chars": _I, "medium_time_fraction": _F, "reports_dir": _P, "selection_seed": _I,
        "short_max_ja_chars": _I, "short_time_fraction": _F, "sources_dir": _P, "target_train_hours": _F, "utterance_padding_seconds": _F, "work_dir": _P,
    },
    "qc": {"max_duration_seconds": _F, "max_en_wer": _F, "max_ja_cer": _F, "min_duration_seconds": _F},
    "run": {
        "checkpoint_every": _I, "expected_hours_per_language": _F, "input_jsonl": _P, "max_pairs_per_shard": _I, "maximum_output_gib": _F, "minimum_cache_free_gib": _F, "minimum_free_gib": _F, "num_shards": _I, "output_dir": _P, "resume": _B,
        "retry_storage_fraction": _F, "save_native": _B,
    },
    "smoke": {"input_jsonl": _P, "maximum_output_gib": _F, "minimum_free_gib": _F, "output_dir": _P, "pair_count": _I},
    "tts": {
        "device": _S, "do_sample": _B, "dtype": _S, "instruct": _S, "max_content_retries": _I, "max_new_tokens": _I, "model_id": _S, "output_sample_rate": _I, "remove_invalid_values": _B, "renormalize_logits": _B, "revision": _S, "speaker": _S,
        "subtalker_do_sample": _B,
    },
}
SOURCE: dict[str, Any] = {"archive_name": _S, "license_id": _S, "sha256": "str | None", "url": _S, "version": _S}
CORPORA = ("jesc", "kftt")
CLASSES = {name: make_dataclass(name.title() + "Settings", list(fields.items()), frozen=True, kw_only=True) for name, fields in SECTIONS.items()}
Source = make_dataclass("Source", [(n, t, field(default=None)) if n == "sha256" else (n, t) for n, t in SOURCE.items()], frozen=True, kw_only=True)
Settings = make_dataclass("Settings", [*CLASSES.items(), ("sources", dict)], frozen=True, kw_only=True)


def _section(raw: Any, name: str) -> dict[str, Any]:
    if not isinstance(raw, dict):
        raise ValueError(f"{name} must hold settings by name")
    return raw


def problems(c: Any, https: bool = True) -> list[str]:
    """What is wrong with settings, all of it."""
    out = []

    def check(ok: bool, what: str) -> None:
        if not ok:
            out.append(what)

    for n in ("num_shards", "max_pairs_per_shard", "checkpoint_every", "minimum_free_gib", "minimum_cache_free_gib", "maximum_output_gib"):
        check(getattr(c.run, n) >= 1, f"run.{n} is below 1")
    for n in ("pair_count", "minimum_free_gib", "maximum_output_gib"):
        check(getattr(c.smoke, n) >= 1, f"smoke.{n} is below 1")
    check(c.smoke.minimum_free_gib >= c.smoke.maximum_output_gib, "smoke.minimum_free_gib is below smoke.maximum_output_gib")
    check(0 <= c.run.retry_storage_fraction <= 1, "run.retry_storage_fraction isn't a fraction")
    p = c.prepare
    check(p.target_train_hours > 0, "prepare.target_train_hours isn't above 0")
    check(0 < p.jesc_fraction < 1, "prepare.jesc_fraction isn't between 0 and 1")
    check(p.ja_chars_per_second > 0, "prepare.ja_chars_per_second isn't above 0")
    check(p.utterance_padding_seconds >= 0, "prepare.utterance_padding_seconds is below 0")
    check(0 < p.short_max_ja_chars < p.medium_max_ja_chars, "the bounds of the length bins don't rise")
    check(abs(p.short_time_fraction + p.medium_time_fraction + p.long_time_fraction - 1) <= 1e-9, "the bins' time fractions don't add up to 1")
    check(set(c.sources) == set(CORPORA), f"sources must be {' and '.join(CORPORA)}")
    for name, s in c.sources.items():
        for n in ("version", "license_id"):
            check(isinstance(getattr(s, n), str) and bool(getattr(s, n)), f"sources.{name}.{n} isn't a string")
        check(not https or s.url.startswith("https://"), f"sources.{name}.url isn't of https")
        check(s.archive_name.endswith(".tar.gz"), f"sources.{name}.archive_name isn't a .tar.gz")
        check(s.sha256 is None or (len(s.sha256) == 64 and set(s.sha256) <= set("0123456789abcdef")), f"sources.{name}.sha256 isn't a digest in lower case")
    check(c.tts.max_content_retries in (0, 1), "tts.max_content_retries is neither 0 nor 1")
    check((c.tts.device, c.tts.dtype) == ("cuda:0", "bfloat16"), "tts needs cuda:0 and bfloat16")
    check(c.tts.output_sample_rate == 16000, "tts.output_sample_rate isn't 16000")
    check(c.asr.dtype == "float16", "asr.dtype isn't float16")
    check(c.device.require_cuda and c.device.require_bf16, "device must require CUDA and BF16")
    check(0 <= c.qc.max_ja_cer <= 1 and 0 <= c.qc.max_en_wer <= 1, "the error rates of qc aren't fractions")
    check(c.qc.min_duration_seconds < c.qc.max_duration_seconds, "the durations of qc don't rise")
    return out


def settings(raw: dict[str, Any], https: bool = True) -> Any:
    """Settings from nested values; TypeError for unknown or missing names, ValueError with all problems."""
    raw = _section(raw, "the file")
    parts = {}
    for name, fields in SECTIONS.items():
        values = {k: Path(v) if fields.get(k) is _P else v for k, v in _section(raw.get(name), name).items()}
        parts[name] = CLASSES[name](**values)
    sources = {n: Source(**_section(v, f"sources.{n}")) for n, v in _section(raw.get("sources"), "sources").items()}
    out = Settings(**parts, sources=sources)
    if wrong := problems(out, https):
        raise ValueError("; ".join(wrong))
    return out


def load(path: Path, https: bool = True) -> Any:
    """Read YAML, or JSON where there is no YAML library."""
    text = path.read_text(encoding="utf-8")
    try:
        import yaml
    except ModuleNotFoundError:
        return settings(json.loads(text), https)
    return settings(yaml.safe_load(text), https)


def trial_settings(c: Any) -> Any:
    """The same for a trial: one shard, its own input and output, no native audio."""
    run = replace(
        c.run, checkpoint_every=1, expected_hours_per_language=c.smoke.pair_count * c.qc.max_duration_seconds / 3600, input_jsonl=c.smoke.input_jsonl, max_pairs_per_shard=c.smoke.pair_count,
        maximum_output_gib=c.smoke.maximum_output_gib, minimum_free_gib=c.smoke.minimum_free_gib, num_shards=1, output_dir=c.smoke.output_dir, save_native=False,
    )
    return replace(c, run=run)
