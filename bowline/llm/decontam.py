"""Benchmark decontamination by one Aho-Corasick automaton.

The windows of all benchmark items (``WINDOW`` consecutive normalised words; an
item with fewer, but some, is one window) are the automaton's patterns, each
between spaces. A document's text is normalised by a byte table that keeps every
byte's place (A-Z to a-z; ASCII other than letters and digits to space), runs of
spaces are joined, and the text is scanned once; hits are word ranges, and the
untouched byte places give each range's characters in the original text.

The benchmark is collected to the driver and broadcast in parts of at most
``PART_BYTES`` of text, one part per pass over the documents: usually one. A
larger benchmark takes more passes, each merging its hits into the row's.

Defined results: null text has no words and no hits; items of null text or null
item_id have no windows; rows that repeat an item_id are one item. Document rows
pass one by one, so repeated rows, null ids and extra columns change nothing.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.llm.common import at_work, free_name

WINDOW = 10
PART_BYTES = 32 * 1024 * 1024

_NORM = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
              for b in range(256))
HITS = ("n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, "
        "ranges array<long>, spans array<long>")


def normalise(text: str) -> bytes:
    """Same length as the text's UTF-8; words are runs of other than space."""
    return text.encode("utf-8", "surrogatepass").translate(_NORM)


def windows_of(text: str | None, size: int = WINDOW) -> list[str]:
    words = normalise(text).split() if text else []
    return [b" ".join(words[k:k + size]).decode("utf-8", "surrogatepass")
            for k in range(max(1, len(words) - size + 1))] if words else []


class Scanner:
    def __init__(self, windows: dict[str, list[str]]):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        self.items: list[list[str]] = []
        for w, items in windows.items():
            self.auto.add_word(f" {w} ", (w.count(" ") + 1, len(self.items)))
            self.items.append(items)
        if windows:
            self.auto.make_automaton()

    def scan(self, text: str | None, before: tuple | None):
        """(n_words, item ids, merged hit word ranges, spans of characters)."""
        raw = normalise(text) if text else b""
        words = raw.split()
        found, ranges = set(before[0]) if before else set(), list(before[1]) if before else []
        if words and self.items:
            line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
            hits = list(self.auto.iter(line))
            if hits:
                gaps = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4") == 32)
                stop = np.searchsorted(gaps, [e for e, _ in hits])
                n = np.array([v[0] for _, v in hits])
                ranges += np.stack([stop - n, stop], axis=1).ravel().tolist()
                for k in {v[1] for _, v in hits}:
                    found.update(self.items[k])
        if not ranges:
            return len(words), [], [], []
        delta = np.zeros(len(words) + 1, np.int64)
        np.add.at(delta, ranges[0::2], 1)
        np.add.at(delta, ranges[1::2], -1)
        inside = np.concatenate(([0], (np.cumsum(delta) > 0).astype(np.int8)[:-1], [0]))
        edge = np.diff(inside)
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # the words' bytes, then characters, in the original text
        solid = np.concatenate(([0], (np.frombuffer(raw, np.uint8) != 32).astype(np.int8), [0]))
        edge = np.diff(solid)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
        spans = np.stack([chars[first[lo]], chars[last[hi - 1]]], axis=1)
        return len(words), sorted(found), np.stack([lo, hi], axis=1).ravel().tolist(), spans.ravel().tolist()


_SCANNERS: dict[str, Scanner] = {}


def _scanner(token: str, windows) -> Scanner:
    at_work("decontamination", _SCANNERS.clear)
    if token not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[token] = Scanner(windows.value)
    return _SCANNERS[token]


def _pass(windows, token: str):
    def rows(texts, befores) -> pd.DataFrame:
        s = _scanner(token, windows)
        out = []
        for t, b in zip(texts, befores):
            n, items, ranges, spans = s.scan(t, b)
            out.append((n, sum(ranges[1::2]) - sum(ranges[0::2]), len(items), items,
                        hashlib.sha256(",".join(items).encode()).hexdigest(), ranges, spans))
        return pd.DataFrame(out, columns=[f.split()[0] for f in HITS.split(", ")])

    @F.pandas_udf(HITS)
    def first(texts: pd.Series) -> pd.DataFrame:
        return rows(texts, [None] * len(texts))

    @F.pandas_udf(HITS)
    def later(texts: pd.Series, items: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        return rows(texts, zip(items, ranges))

    return first, later


def _parts(spark: SparkSession, benchmark: DataFrame, window: int, part_bytes: int):
    """Broadcast windows -> item ids, at most ``part_bytes`` of text at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    for k in range(parts):
        windows: dict[str, set[str]] = {}
        for item, text in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect():
            for w in windows_of(text, window):
                windows.setdefault(w, set()).add(item)
        yield spark.sparkContext.broadcast({w: sorted(i) for w, i in windows.items()})


def benchmark_hits(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, into: str, window: int = WINDOW,
                   part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with a column ``into``: a struct of HITS."""
    text: Column = F.col("text").cast("string")
    for k, windows in enumerate(_parts(spark, benchmark, window, part_bytes)):
        first, later = _pass(windows, uuid.uuid4().hex)
        hit = first(text) if k == 0 else later(text, F.col(into)["items"], F.col(into)["ranges"])
        docs = docs.withColumn(into, hit)
    return docs


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit word, columns unchanged."""
    hits = free_name(docs, "hits")
    return benchmark_hits(spark, docs, benchmark, hits, window).where(F.col(hits)["n_hit"] == 0).drop(hits)
