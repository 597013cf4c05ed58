"""Folder names made from free text."""

from __future__ import annotations

import hashlib

_PLAIN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-+")


def safe_name(name: str) -> str:
    """A folder name; different texts give different names (other bytes than plain ones become ``~XX``)."""
    return "".join(chr(b) if chr(b) in _PLAIN else f"~{b:02X}" for b in name.encode())


def tag(*parts: object) -> str:
    """A short fingerprint of what tells two queries of one job apart."""
    return hashlib.sha256("\0".join(map(str, parts)).encode()).hexdigest()[:12]
