"""Sizes of join sides: a side is broadcast only when its estimate fits."""

from __future__ import annotations


def wide_row_bytes(k: int, key_bytes: float = 24) -> float:
    """Rough in-memory bytes of a (key, k doubles) row in a hashed relation;
    for text keys ``key_bytes`` is their measured mean."""
    return key_bytes + 8 * k + 32
