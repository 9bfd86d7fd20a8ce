"""Parsing of options, names and digests."""

from __future__ import annotations

import hashlib
import re


def vec3(text: str | None, default: tuple[float, float, float]) -> tuple[float, ...]:
    """Three numbers apart by commas or spaces; the default for any other count."""
    parts = (text or "").replace(",", " ").split()
    return tuple(map(float, parts)) if len(parts) == 3 else tuple(default)


def safe_name(text: str, empty: str = "cmap") -> str:
    """White space, slashes, commas, colons, semicolons and parentheses become single underscores."""
    return re.sub(r"[\s/\\:;,()_]+", "_", text.strip()).strip("_") or empty


def has_sha256(body: bytes, digest: str | None) -> bool:
    """Whether the SHA-256 is as given, in either case; nothing given is always right."""
    return digest is None or hashlib.sha256(body).hexdigest() == digest.lower()
