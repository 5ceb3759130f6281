"""BPE encoding and decoding with content-defined chunk reuse.

A text's bytes are cut where a rolling hash of the last 32 bytes has ``MASK_BITS``
zero bits, so a passage gives the same chunks in whatever document and at
whatever place it stands. A worker keeps chunks with their ids in a store bounded
in bytes; a chunk that documents share is encoded once while it is there.

A cut may fall inside a word. A chunk's ids therefore cover only what stands
between its first and its last white space; the ends of two neighbours make one
straddling run, which is encoded again together with the whole runs on both
sides, looked for in a view that is widened until it holds one. If that encoding
starts and ends with exactly the ids that those runs have in their own chunks,
the part in between is spliced in; else the whole text is encoded again. A chunk
without white space is part of the straddling run.

White space is a safe place because the tokenizer splits text by a pattern that
matches no white space and drops the rest (checked when it is loaded; any other
tokenizer encodes whole texts). Unicode composition and lower-casing do not
reach across it either.

Defined results: a null text is the empty text (no ids, empty decoded text). Rows
pass one by one, so repeated rows, null ids and empty tables are no case of their
own; extra columns are ignored. Memory of a task: one text, groups of texts of
about ``GROUP_BYTES`` and the two stores.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.llm.common import arrow_map, at_work

MASK_BITS = 11                 # chunks of about 2 KB
LEAST, MOST = 256, 1 << 16     # bytes of a chunk
CHUNK_STORE = 32 << 20         # bytes of chunks, runs and ids remembered in a worker
RUN_STORE = 160 << 20
GROUP_BYTES = 4 << 20          # texts looked up together
LONG_RUN = 512                 # longer runs are not remembered

_SPACE = re.compile(rb"[\x09-\x0D ]")
_EDGE = re.compile(rb"[^\x09-\x0D ]*")
# Text in these bytes (ASCII, Latin-1) holds no combining marks, so its ASCII
# letters can be lower-cased before it is looked up.
_PLAIN = bytes([9, 10, 13, *range(32, 127), *range(0x80, 0xC0), 0xC2, 0xC3])
# Punctuation between these neighbours is a word of its own for the pattern, and
# can be set apart: more runs are the same.
_POINTS = re.compile(rb"(?<![^a-z0-9\s])([!-&(-/:-@\[-`{-~]+)(?![^a-z0-9\s])")
_GEAR = np.random.default_rng(20240301).integers(0, 2**32, 256, dtype=np.uint32)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut_points(raw: bytes, mask_bits: int = MASK_BITS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Places of the cuts in ``raw`` (UTF-8), its end included."""
    b = np.frombuffer(raw, np.uint8)
    h = _GEAR[b]
    for k in (1, 2, 4, 8, 16):      # h[i] is then a hash of bytes i-31..i
        if k < len(h):
            more = h.copy()
            more[k:] += h[:-k] << np.uint32(k)
            h = more
    hits = np.flatnonzero((h >> np.uint32(32 - mask_bits)) == 0) + 1
    out, last = [], 0
    for p in chain(hits.tolist(), (len(raw),)):
        while p - last > most:
            q = last + most
            while raw[q] & 0xC0 == 0x80:
                q -= 1
            out.append(q)
            last = q
        while p < len(raw) and raw[p] & 0xC0 == 0x80:
            p += 1
        if p - last >= least and p < len(raw):
            out.append(p)
            last = p
    return out + [len(raw)] if len(raw) > last else out


class Store:
    """A map bounded in bytes, in two generations: when the younger is full it
    becomes the older one, and what was not used since then goes."""

    def __init__(self, limit: int):
        self.half, self.used = limit // 2, 0
        self.young: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}

    def get(self, key: bytes):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key: bytes, value) -> None:
        self.used += len(key) + (len(value) if isinstance(value, bytes) else len(value[1] or b"")) + 150
        if self.used > self.half:
            self.old, self.young, self.used = self.young, {}, 0
        self.young[key] = value


class ChunkCodec:
    def __init__(self, path: str, mask_bits: int = MASK_BITS, least: int = LEAST, most: int = MOST,
                 chunk_store: int = CHUNK_STORE, run_store: int = RUN_STORE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        config = json.loads(self.tok.to_str())
        self.shape = (mask_bits, least, most)
        self.special = [t.content.lower().encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.stable = splits_at_space(config) and not any(_SPACE.search(s) for s in self.special)
        self.joined = config["decoder"] is None       # decoded: the pieces with spaces between
        size = max(self.tok.get_vocab(with_added_tokens=True).values(), default=-1) + 1
        self.pieces = [self.tok.id_to_token(i) or "" for i in range(size)]
        self.chunks, self.runs, self.joins = Store(chunk_store), Store(run_store), Store(run_store // 4)
        self.encoded_chunks = self.repaired = 0

    def library(self, texts: list[str]) -> list[bytes]:
        batch = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in batch]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit integers."""
        if not self.stable:
            return [self.library([t])[0] if t else b"" for t in texts]
        out, group, held = [], [], 0
        for t in texts:
            group.append(t.encode() if t else b"")
            held += len(group[-1])
            if held > GROUP_BYTES:
                out += self._encode(group)
                group, held = [], 0
        return out + self._encode(group)

    def decode(self, ids: bytes) -> str:
        ids = np.frombuffer(ids, "<u4").tolist()
        return " ".join(map(self.pieces.__getitem__, ids)) if self.joined \
            else self.tok.decode(ids, skip_special_tokens=False)

    def _encode(self, raws: list[bytes]) -> list[bytes]:
        docs = []
        for raw in raws:
            cuts = cut_points(raw, *self.shape)
            docs.append([raw[a:b] for a, b in zip([0, *cuts], cuts)])
        found = self._look_up(set(chain.from_iterable(docs)))
        laid, wanted = [], {}
        for raw, chunks in zip(raws, docs):
            parts, start, at = [], 0, 0       # ids, or a straddling run that is encoded again
            for c in chunks:
                head, body, tail = found[c]
                if body is not None:
                    parts += [raw[start:at + len(head)], body]
                    wanted.setdefault(parts[-2], (raw, start))
                    start = at + len(c) - len(tail)
                at += len(c)
            parts.append(raw[start:])
            wanted.setdefault(parts[-1], (raw, start))
            laid.append(parts)
        known = self._repair(wanted)
        out = []
        for raw, parts in zip(raws, laid):
            ids = [known[x] if k % 2 == 0 else x for k, x in enumerate(parts)]
            out.append(self.library([raw.decode()])[0] if None in ids else b"".join(ids))
        return out

    def _look_up(self, chunks: Iterable[bytes]) -> dict[bytes, tuple]:
        """Chunk -> (its end of a run at the start, ids in between, its end of a
        run at the end); chunks that no text brought before are encoded."""
        found, fresh, runs = {}, {}, set()
        for c in chunks:
            entry = self.chunks.get(c)
            if entry is not None:
                found[c] = entry
                continue
            head = _EDGE.match(c).group()
            if len(head) == len(c):
                found[c] = (c, None, b"")
                continue
            tail = _EDGE.match(c[::-1]).group()[::-1]
            fresh[c] = (head, self._runs_of(c[len(head):len(c) - len(tail)]), tail)
            runs.update(fresh[c][1])
        ids = self._run_ids(runs)
        for c, (head, body, tail) in fresh.items():
            found[c] = (head, b"".join(map(ids.__getitem__, body)), tail)
            self.chunks.put(c, found[c])
        self.encoded_chunks += len(fresh)
        return found

    def _runs_of(self, body: bytes) -> list[bytes]:
        low = body.lower()
        if low.translate(None, _PLAIN) or any(s in low for s in self.special):
            return body.split()
        return _POINTS.sub(rb" \1 ", low).split()

    def _run_ids(self, runs: Iterable[bytes]) -> dict[bytes, bytes]:
        out, fresh = {}, []
        for r in runs:
            ids = self.runs.get(r)
            if ids is None:
                fresh.append(r)
            else:
                out[r] = ids
        for lo in range(0, len(fresh), 256):
            part = fresh[lo:lo + 256]
            for r, ids in zip(part, self._apart([r.decode() for r in part])):
                out[r] = ids
                if len(r) <= LONG_RUN:
                    self.runs.put(r, ids)
        return out

    def _apart(self, runs: list[str]) -> list[bytes]:
        """Ids of each run: they are encoded together, which is cheaper, and the
        ids cut apart by the place that each was made from."""
        e = self.tok.encode(" ".join(runs), add_special_tokens=False)
        starts = np.cumsum([0] + [len(r) + 1 for r in runs[:-1]])
        at = np.searchsorted(starts, np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids)), "right") - 1
        if len(at) and (np.diff(at) < 0).any():
            return self.library(runs)
        raw = np.asarray(e.ids, "<u4").tobytes()
        stops = (4 * np.cumsum(np.bincount(at, minlength=len(runs)))).tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]

    def _repair(self, wanted: dict[bytes, tuple[bytes, int]]) -> dict[bytes, bytes | None]:
        """Ids of the straddling runs, each encoded again with the run before and
        the run after it; None where these don't come out as they are known."""
        out, windows = {b"": b""}, {}
        for run, (raw, start) in wanted.items():
            ids = self.joins.get(run) if run else b""
            if ids is None:
                windows[run] = (_run_before(raw, start), _run_after(raw, start + len(run)))
            else:
                out[run] = ids
        known = self._run_ids({r for pair in windows.values() for r in pair if r})
        texts = [b" ".join(filter(None, (a, run, b))).decode() for run, (a, b) in windows.items()]
        for (run, (a, b)), ids in zip(windows.items(), self.library(texts) if texts else ()):
            first, last = known.get(a, b""), known.get(b, b"")
            agree = len(ids) >= len(first) + len(last) and ids.startswith(first) and ids.endswith(last)
            out[run] = ids[len(first):len(ids) - len(last)] if agree else None
            self.repaired += 1
            if agree and len(run) <= LONG_RUN:
                self.joins.put(run, out[run])
        return out


def _run_before(raw: bytes, at: int) -> bytes:
    """The last whole run that ends before ``at``; the view is widened until it
    holds one."""
    reach = 64
    while True:
        lo = max(0, at - reach)
        runs = raw[lo:at].split()
        if lo == 0 or len(runs) > 1:
            return runs[-1] if runs else b""
        reach *= 4


def _run_after(raw: bytes, at: int) -> bytes:
    reach = 64
    while True:
        runs = raw[at:at + reach].split()
        if at + reach >= len(raw) or len(runs) > 1:
            return runs[0] if runs else b""
        reach *= 4


def splits_at_space(config: dict) -> bool:
    """Whether the tokenizer's first step keeps only matches of a pattern that
    matches no white space, so that no token spans any."""
    pre = config.get("pre_tokenizer") or {}
    first = pre["pretokenizers"][0] if pre.get("type") == "Sequence" else pre
    if first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert"):
        return False
    pattern = re.sub(r"\[\^\\s[^\]]*\]", "", first["pattern"].get("Regex", " "))
    return not re.search(r"\\s|\\W|\\D|\[\^|\.| ", pattern)


@lru_cache(maxsize=2)
def codec(path: str) -> ChunkCodec:
    return ChunkCodec(path)


def _codec_fn(path: str | None):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()),
                        ("decoded", pa.string())])

    def fn(cols):
        at_work("bpe", codec.cache_clear)
        c = codec(path or default_tokenizer())
        ids = c.encode(cols["text"])
        return {"doc_id": cols["doc_id"], "n_tokens": [len(i) // 4 for i in ids], "ids": ids,
                "decoded": [c.decode(i) for i in ids]}

    return arrow_map(fn, schema)


def encode_documents(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_tokens, ids (little-endian
    unsigned 32-bit) and the text decoded from them."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_codec_fn(tokenizer), "doc_id long, n_tokens long, ids binary, decoded string")
