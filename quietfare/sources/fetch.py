"""Downloads in chunks with a hash and a cached manifest."""

from __future__ import annotations

import hashlib
import json
import os
import re
import urllib.request
from datetime import UTC, datetime
from pathlib import Path

from quietfare.sources.sinks import write_json

CHUNK = 1 << 20


def download(url: str, target: Path) -> tuple[str, int]:
    """SHA-256 and size of ``url``, stored at ``target``; an interrupted download leaves no target."""
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    digest, size = hashlib.sha256(), 0
    try:
        with urllib.request.urlopen(url) as source, part.open("wb") as out:
            for piece in iter(lambda: source.read(CHUNK), b""):
                digest.update(piece)
                size += out.write(piece)
        os.replace(part, target)
    finally:
        part.unlink(missing_ok=True)
    return digest.hexdigest(), size


def fetch(url: str, target: Path, refresh: bool = False) -> dict:
    """The manifest of ``target``, downloaded unless both file and manifest are there."""
    manifest = target.with_name(target.name + ".manifest.json")
    if not refresh and target.exists() and manifest.exists():
        return json.loads(manifest.read_text())
    sha256, size = download(url, target)
    record = {"source_url": url, "download_date_utc": datetime.now(UTC).isoformat(), "sha256": sha256, "bytes": size}
    write_json(record, manifest)
    return record


#: Fixed value: how a month's file is named.
MONTH_FILE = "fhvhv_tripdata_{month}.parquet"


def fetch_month(month: str, base_url: str, folder: str | Path, refresh: bool = False) -> dict:
    """The manifest of a month's file (``YYYY-MM``) under ``folder``, with the month itself; a month of another form is an error."""
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", month):
        raise ValueError(f"{month} is no month of the form YYYY-MM")
    name = MONTH_FILE.format(month=month)
    return {"month": month, **fetch(f"{base_url.rstrip('/')}/{name}", Path(folder) / name, refresh)}
