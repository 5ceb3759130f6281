"""Token counts, with huge documents encoded in overlapping chunks.

A huge text is cut into chunks that overlap. Each chunk is encoded, the byte
offset of every token follows from the pieces' lengths, and two neighbouring
encodings are spliced at a boundary that both have inside the overlap and that
is proven stable: a token start at a space whose predecessor is no space. The
model joins symbols only into pieces of its vocabulary, and (checked when the
model is loaded) no piece holds a space mark after another character; so no
merge reaches across such a boundary, and what stands on either side cannot
change it. When an overlap holds no such boundary it is widened until one is
found or the chunk reaches the end of the text.

Memory per task is one text and one chunk's ids. A model that fails the proof is
used on whole texts only. Defined results: null text counts as empty: 0 bytes, 0
tokens. Rows pass one by one, so repeated rows, null ids and extra columns are
no case of their own; the added columns replace columns of the same name.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 8192       # characters of a chunk
OVERLAP = 256      # characters two chunks share at first
LIMIT = 4096       # tokens beyond which a document is over the limit
MARK = "▁"    # the model's mark for a space


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Counter:
    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        n = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(n)]
        # UTF-8 length of the text behind each piece
        self.bytes = np.array([1 if self.sp.is_byte(i) else len(p.replace(MARK, " ").encode())
                               for i, p in enumerate(pieces)], np.int64)
        self.stable = not any(MARK in p.lstrip(MARK) for p in pieces)

    def offsets(self, text: str) -> np.ndarray | None:
        """Byte offset of each token of ``text``, then its end; None where the
        pieces don't spell the text (the model rewrites it or marks unknowns)."""
        ids = np.asarray(self.sp.encode(text), np.int64)
        ends = np.cumsum(self.bytes[ids]) - 1        # without the space put before the text
        if not len(ids) or ends[-1] != len(text.encode()):
            return None
        return np.concatenate(([0], ends))

    def count(self, text: str) -> int:
        if len(text) <= 2 * self.chunk or not self.stable or MARK in text:
            return len(self.sp.encode(text))
        total, lo, overlap = 0, 0, self.overlap
        # ``lo``: where the chunk's text starts. After a splice that is behind
        # the boundary's space, as the model puts a space before every text.
        while True:
            hi = lo + self.chunk
            if hi + overlap >= len(text):
                return total + len(self.sp.encode(text[lo:]))
            left = self.offsets(text[lo:hi + overlap])
            right = self.offsets(text[hi:hi + 2 * overlap + 1])
            cut = None if left is None or right is None else self._common(text, lo, hi, overlap, left, right)
            if cut is None:
                overlap *= 2                          # no alignment: widen
                continue
            at, tokens = cut
            total += tokens
            lo, overlap = at + 1, self.overlap

    def _common(self, text, lo, hi, overlap, left, right):
        """The first stable boundary that both encodings have in the overlap:
        (its place, tokens of the left encoding before it)."""
        base = len(text[lo:hi].encode())
        starts = set((right[1:] + base).tolist())
        part = text[hi:hi + overlap]
        at = part.find(" ", 1)
        while at > 0:
            if part[at - 1] != " ":
                byte = base + len(part[:at].encode())
                k = bisect_left(left, byte)
                if k < len(left) - 1 and left[k] == byte and byte in starts:
                    return hi + at, k
            at = part.find(" ", at + 1)
        return None


@lru_cache(maxsize=4)
def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Counter:
    return Counter(path, chunk, overlap)


def token_count(text, model: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP):
    """Column of token counts of the text column ``text``."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        c = counter(model or default_model(), chunk, overlap)
        return pd.Series([c.count(t) if t else 0 for t in texts], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, model: str | None = None, limit: int = LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit."""
    text = F.col("text").cast("string")
    return (docs.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
            .withColumn("n_tokens", token_count(text, model, chunk, overlap))
            .withColumn("over_limit", F.col("n_tokens") > limit))
