"""Fetching and unpacking source archives, on the driver: digests are verified, and nothing half-done is left under a final name."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import tarfile
import time
import urllib.request
from pathlib import Path


def file_digest(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def fetch(url: str, to: Path, sha256: str | None = None) -> dict[str, object]:
    """Fetch ``url``, of any scheme that urllib knows, unless ``to`` is there; ValueError for a wrong digest.

    A partial download of an earlier run is thrown away. Gives path, sha256, bytes, reused and download_seconds.
    """
    began = time.time()
    reused = to.is_file()
    if not reused:
        to.parent.mkdir(parents=True, exist_ok=True)
        part = to.with_name(to.name + ".part")
        part.unlink(missing_ok=True)
        try:
            with urllib.request.urlopen(url) as source, part.open("wb") as sink:  # noqa: S310
                shutil.copyfileobj(source, sink, 1 << 20)
                sink.flush()
                os.fsync(sink.fileno())
            if sha256 and (got := file_digest(part)) != sha256:
                raise ValueError(f"{url}: its digest is {got}, not {sha256}")
            part.replace(to)
        finally:
            part.unlink(missing_ok=True)
    got = file_digest(to)
    if sha256 and got != sha256:
        raise ValueError(f"{to}: its digest is {got}, not {sha256}")
    return {"path": str(to), "sha256": got, "bytes": to.stat().st_size, "reused": reused, "download_seconds": round(time.time() - began, 3)}


def safe_members(archive: tarfile.TarFile, into: Path) -> list[tarfile.TarInfo]:
    """All members; ValueError for one that isn't a plain file or folder within ``into``."""
    root = into.resolve()
    out = []
    for m in archive.getmembers():
        inside = not os.path.isabs(m.name) and ".." not in Path(m.name).parts and (root / m.name).resolve().is_relative_to(root)
        if not inside or not (m.isfile() or m.isdir()):
            raise ValueError(f"unsafe archive member {m.name!r}")
        out.append(m)
    return out


def unpack(archive: Path, into: Path, sha256: str) -> Path:
    """Unpack once for each digest. The folder appears under its name when it is complete; one without a mark is an error."""
    mark = into / ".complete.json"
    if into.exists():
        if mark.is_file() and json.loads(mark.read_text()).get("sha256") == sha256:
            return into
        raise ValueError(f"{into} isn't the whole of this archive; remove it to unpack again")
    temporary = into.with_name(into.name + ".unpacking")
    shutil.rmtree(temporary, ignore_errors=True)
    temporary.mkdir(parents=True)
    with tarfile.open(archive) as tar:
        tar.extractall(temporary, members=safe_members(tar, temporary), filter="data")
    (temporary / mark.name).write_text(json.dumps({"sha256": sha256}))
    temporary.replace(into)
    return into


def first_existing(root: Path, *candidates: str) -> Path:
    """The first of several layouts that is there."""
    for c in candidates:
        if (root / c).exists():
            return root / c
    raise FileNotFoundError(f"{root} has none of {', '.join(candidates)}")
