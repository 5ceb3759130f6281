"""Tokenisation, as a column expression (JVM built-ins only) and of UTF-8 bytes in a task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed token rule: lower-case, split on runs of characters outside [a-z0-9],
# drop empty pieces.
TOKEN_SPLIT = "[^a-z0-9]+"


def tokens(text: Column | str) -> Column:
    """array<string> of the tokens of a text (whole text, never a prefix)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(F.coalesce(col, F.lit(""))), TOKEN_SPLIT), "")


# Every byte that no token holds becomes a space; no byte of a multi-byte character is among [a-z0-9].
_TOKEN_BYTES = bytes(b if chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for b in range(256))


def lower_words(text: bytes) -> list[bytes]:
    """The tokens of a text that is lower-cased already, as ``tokens`` gives them."""
    return text.translate(_TOKEN_BYTES).split()
