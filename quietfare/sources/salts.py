"""Salts: made at random, kept in a folder of their own under their fingerprint, never named by value."""

from __future__ import annotations

import os
from pathlib import Path

from quietfare.functions.hashing import salt_fingerprint

SALT_BYTES = 16


def generate_salt(size: int = SALT_BYTES) -> bytes:
    return os.urandom(size)


def write_salt(salt: bytes, folder: str | Path) -> Path:
    """Keeps ``salt`` in ``folder``, readable by the owner alone; its pseudonyms can't be linked once the file is gone."""
    target = Path(folder) / f"{salt_fingerprint(salt)}.salt"
    target.parent.mkdir(parents=True, exist_ok=True)
    with os.fdopen(os.open(target, os.O_WRONLY | os.O_CREAT | os.O_TRUNC, 0o600), "wb") as out:
        out.write(salt)
    return target


def read_salt(path: str | Path) -> bytes:
    return Path(path).read_bytes()
