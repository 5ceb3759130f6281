"""Full-batch gradient descent over term blocks.

The weights of a run are W = c W0 + X^T A: a gradient step adds eta * X^T R to them,
R being the residuals (a row for each document), and shrinks them. So a run's state is A
and the scores Z = X W, rows for documents, and W is summed up only when somebody asks
for it. There are far fewer documents than terms, and no step moves a cell or a weight:

  blocks  the cells of a share of the terms, written once, bucketed by block: packed
          chunks (documents, terms, counts) for each share of the documents
  state   packed rows (documents, classes, A, Z) for each share of the documents
  a step  A goes to every block; there G = X_b^T A, then X_b G, summed by share of the
          documents to the new Z

Other splits (held out, unlabelled) may lie in the same blocks: they have no part in
A, and their scores come along. Column sums of a split to normalise are taken in the
block, and divide rows of G instead of cells.

Memory: cells are packed where they are read, a buffer at a time, and the pieces of a
chunk are put together by themselves. A task of a step keeps the weights of its block's
terms (``WEIGHT_BYTES``) and one chunk (``CHUNK_CELLS``); chunks and what was sent wait in
an unnamed local file for the two passes over them. Blocks follow the weights, and the
cells (``BLOCK_CELLS``, what such a file holds); shares of the documents follow the chunks
and the state (``STATE_BYTES``), and a task puts the scores of a few of them together.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.session import importable, work_path
from bowline.sources.tables import release, written_table

BLOCK_CELLS = 64_000_000        # cells of a block, about 6 bytes each
WEIGHT_BYTES = 64 << 20         # weights and sums of a block's terms
CHUNK_CELLS = 96 << 10          # cells of a block and a share of the documents
STATE_BYTES = 384 << 10         # A of a share of the documents
GROUPED = 4                     # shares of the documents that are put together at once
PIECE_CELLS = 1 << 18           # cells that a task packs at once
TERMS_OUT = 1 << 15             # rows of weights handed on at once

STATE = "part int, dc bigint, docs binary, classes binary, a binary, z binary, z0 binary"
BLOCK = "tb bigint, part int, dc bigint, docs binary, ends binary, terms binary, at binary, x binary"
_FLOW = pa.schema([("part", pa.int32()), ("dc", pa.int64()), ("docs", pa.binary()), ("z", pa.binary()), ("tb", pa.int64())])
_STATE = pa.schema([("part", pa.int32()), ("dc", pa.int64()), *[(n, pa.binary()) for n in ("docs", "classes", "a", "z", "z0")]])
_IDS = [("tb", pa.int64()), ("part", pa.int32()), ("dc", pa.int64())]
_PIECE = pa.schema([("tb", pa.int64()), ("part", pa.int32()), ("dg", pa.int64()), *[(n, pa.binary()) for n in ("docs", "shares", "sizes", "keys", "x")]])
_BLOCK = pa.schema([*_IDS, *[(n, pa.binary()) for n in ("docs", "ends", "terms", "at", "x")]])

SENT_A, SENT_W = -2, -3         # ``part`` of what is sent to a block: A of a share, weights

# Rows of chunks and of states have up to half a MB (larger arrays the JVM's collector keeps
# apart, in regions of their own): so many are read and handed to Python at once.
ROWS_AT_ONCE = 8


@contextmanager
def few_rows_at_once(spark: SparkSession):
    """While a plan over packed rows runs: batches of ``ROWS_AT_ONCE`` rows, for the
    session's defaults are rows of a few numbers."""
    held = {n: spark.conf.get(n, None) for n in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")}
    try:
        for n in held:
            spark.conf.set(n, str(ROWS_AT_ONCE))
        yield
    finally:
        for n, v in held.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _ints(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def _matrix(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(-1, width) if width else np.zeros((0, 0))


def _sums(at: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(at, weights=values, minlength=rows) if len(at) else np.zeros(rows)


def _columns(batches, *names: str) -> list[np.ndarray]:
    """All rows of the batches, a NumPy array for each column."""
    parts = [[b.column(n).to_numpy(zero_copy_only=False) for n in names] for b in batches if b.num_rows]
    return [np.concatenate(c) for c in zip(*parts)] if parts else []


def softmax(z: np.ndarray, stable: bool) -> np.ndarray:
    """Probabilities of k classes from k - 1 scores; the last class is pinned."""
    z = np.hstack([z, np.zeros((len(z), 1))])
    with np.errstate(all="ignore"):
        e = np.exp(z - z.max(axis=1, keepdims=True)) if stable else np.exp(z)
        total = np.abs(e).sum(axis=1, keepdims=True)
        return np.where(total == 0, e, e / total)


def slots(spark: SparkSession, n: int) -> list[int]:
    """``n`` integers that a repartition by key to ``n`` sends to a partition each."""
    found: dict[int, int] = {}
    lo = 0
    while len(found) < n:
        for r in spark.range(lo, lo + 16 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p")).collect():
            found.setdefault(r["p"], r["id"])
        lo += 16 * n
    return [found[p] for p in range(n)]


def _slot(col: str, labels: list[int]) -> Column:
    return F.get(F.array(*[F.lit(v).cast("bigint") for v in labels]), F.pmod(F.xxhash64(col), F.lit(len(labels))).cast("int"))


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in one, two or eight bytes each."""
    if len(x) and x.min() >= 0 and x.max() < 1 << 16:
        small = x.astype(np.uint8 if x.max() < 1 << 8 else np.uint16)
        if (small == x).all():
            return small
    return x.astype(np.float64)


def _wide(raw, n: int) -> np.ndarray:
    return np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 8: np.float64}[len(raw) // n if n else 8])


def _pack_pieces(labels: list[int], groups: int, most: int):
    """Rows of cells to a piece for each block and group of shares of the documents."""
    def pieces(held: list) -> pa.RecordBatch:
        tb, part, dc, doc, key, x = _columns(held, "tb", "part", "dc", "doc_id", "tkey", "x")
        new = np.ones(len(doc), bool)
        new[1:] = (np.diff(doc) != 0) | (np.diff(part) != 0)
        run = np.cumsum(new) - 1                       # the cells of a row lie together
        code = (part.astype(np.int64) * groups + dc % groups) * len(labels) + tb
        order = np.argsort(code * (run[-1] + 1) + run, kind="stable")
        code, run, key, x = code[order], run[order], key[order], x[order]
        cut = np.ones(len(doc), bool)
        cut[1:] = np.diff(code) != 0
        new[1:] = cut[1:] | (np.diff(run) != 0)
        rows, starts = np.flatnonzero(new), np.flatnonzero(cut)        # documents of pieces, pieces
        sizes = np.diff(np.append(rows, len(doc))).astype(np.int32)
        docs, shares = doc[order[rows]], dc[order[rows]].astype(np.int32)
        ends, first = np.append(starts[1:], len(doc)), np.searchsorted(rows, starts)
        last, at = np.append(first[1:], len(rows)), code[starts]
        ids = [pa.array(np.array(labels)[at % len(labels)]), pa.array((at // len(labels) // groups).astype(np.int32)),
               pa.array(at // len(labels) % groups)]
        packed = [[c[i:j].tobytes() for i, j in zip(first, last)] for c in (docs, shares, sizes)]
        packed += [[key[i:j].tobytes() for i, j in zip(starts, ends)], [_narrow(x[i:j]).tobytes() for i, j in zip(starts, ends)]]
        return pa.RecordBatch.from_arrays(ids + [pa.array(c, pa.binary()) for c in packed], schema=_PIECE)

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= most:
                yield pieces(held)
                held, n = [], 0
        if held:
            yield pieces(held)
    return pack


def _merge_pieces(most: int):
    """The pieces of a block and a group of shares to a chunk for each share (to several,
    where few documents hold very many cells)."""
    def chunks(tb: int, part: int, held: list) -> Iterator[pa.RecordBatch]:
        doc, dc, key, x = (np.concatenate(c) for c in zip(*held))
        docs, first, doc_at = np.unique(doc, return_index=True, return_inverse=True)
        dc = dc[first]
        by = np.lexsort((docs, dc))
        docs, dc, place = docs[by], dc[by], np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        doc_at = place[doc_at]
        order = np.argsort(doc_at, kind="stable")
        key, x, ends = key[order], x[order], np.cumsum(np.bincount(doc_at, minlength=len(docs)))
        cuts = [0, *(np.flatnonzero(np.diff(dc)) + 1), len(docs)]
        for i, j in zip(cuts, cuts[1:]):
            lo, hi = ends[i - 1] if i else 0, ends[j - 1]
            terms, at = np.unique(key[lo:hi], return_inverse=True)
            at = at.astype(np.uint16 if len(terms) <= 1 << 16 else np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(v)], t) for v, (_, t) in zip((tb, part, dc[i]), _IDS)]
                + [pa.array([c.tobytes()], pa.binary())
                   for c in (docs[i:j], (ends[i:j] - lo).astype(np.int32), terms, at, _narrow(x[lo:hi]))], schema=_BLOCK)

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, (tb, part, _) = [], 0, (v.as_py() for v in key)
        for batch in batches:
            for docs, shares, sizes, keys, x in zip(*(batch.column(c) for c in ("docs", "shares", "sizes", "keys", "x"))):
                keys, sizes = _ints(keys.as_buffer()).copy(), np.frombuffer(sizes.as_buffer(), np.int32)
                held.append((np.repeat(_ints(docs.as_buffer()), sizes), np.repeat(np.frombuffer(shares.as_buffer(), np.int32), sizes),
                             keys, _wide(x.as_buffer(), len(keys)).astype(np.float64)))
                n += len(keys)
                if n >= most:
                    yield from chunks(tb, part, held)
                    held, n = [], 0
        if held:
            yield from chunks(tb, part, held)
    return merge


def _pack_docs(k: int):
    def pack(batches):
        got = _columns(batches, "part", "dc", "doc_id", "class_id")
        if not got:
            return
        part, dc, doc, cls = got
        order = np.lexsort((doc, dc, part))
        cuts = np.flatnonzero((np.diff(part[order]) != 0) | (np.diff(dc[order]) != 0)) + 1
        for mine in np.split(order, cuts):
            p, zero = part[mine[0]], np.zeros((len(mine), k))
            yield pa.RecordBatch.from_pylist([dict(
                part=int(p), dc=int(dc[mine[0]]), docs=doc[mine].tobytes(), classes=cls[mine].astype(np.int32).tobytes(),
                a=(zero if p == 0 else zero[:0]).tobytes(), z=zero[:, 1:].tobytes(), z0=b"")], schema=_STATE)
    return pack


def _advance(k: int, eta: float, lam: float, stable: bool, shrunk: float):
    """A after a step whose scores are at hand; ``shrunk`` is what the step leaves of
    the scores of the weights the run began with."""
    def advance(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                if r["part"] == 0:
                    cls = np.frombuffer(r["classes"], np.int32)
                    p = softmax(_matrix(r["z"], k - 1) if k > 1 else np.zeros((len(cls), 0)), stable)
                    res = (cls[:, None] == np.arange(1, k + 1)) - p
                    res[cls == 0] = 0                  # without a class, no residual
                    r["a"] = ((1.0 - eta * lam) * _matrix(r["a"], k) + eta * res).tobytes()
                if r["z0"]:
                    r["z0"] = (np.frombuffer(r["z0"]) * shrunk).tobytes()
            yield pa.RecordBatch.from_pylist(rows, schema=_STATE)
    return advance


class _Block:
    """A block of terms in a task: its chunks and what was sent to it lie in a local
    file, and are read from there a chunk at a time."""

    def __init__(self, file, k: int, normalize: list[int]):
        self.file, self.k, self.normalize = file, k, normalize
        self.chunks: list[tuple[int, int, list[tuple[int, int]]]] = []
        self.sent: dict[int, list[tuple[int, int]]] = {}
        self.given: list[list[tuple[int, int]]] = []
        self.terms = np.zeros(0, np.int64)

    def _put(self, *arrays) -> list[tuple[int, int]]:
        return [(self.file.tell(), self.file.write(a.as_buffer())) for a in arrays]

    def _get(self, at: tuple[int, int]) -> bytes:
        self.file.seek(at[0])
        return self.file.read(at[1])

    def fill(self, batches: Iterator[pa.RecordBatch]) -> None:
        seen, n = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("docs", "ends", "terms", "at", "x")]
            for i, (part, dc) in enumerate(zip(batch.column("part").to_pylist(), batch.column("dc").to_pylist())):
                docs, ends, terms, at, x = (c[i] for c in columns)
                if part == SENT_A:
                    self.sent[dc] = self._put(docs, x)
                elif part == SENT_W:
                    self.given.append(self._put(docs, x))
                else:
                    self.chunks.append((part, dc, self._put(docs, ends, terms, at, x)))
                if part == 0:
                    seen.append(_ints(terms.as_buffer()).copy())
                    n += len(seen[-1])
                    if n > PIECE_CELLS + len(self.terms):
                        self.terms, seen, n = np.unique(np.concatenate([self.terms, *seen])), [], 0
        self.terms = np.unique(np.concatenate([self.terms, *seen]))

    def _chunk(self, places) -> tuple[np.ndarray, ...]:
        """(documents, cells of each, its terms' places, whether they are known, term of a cell, values)"""
        docs, ends, terms, at, x = (self._get(p) for p in places)
        docs, ends, terms = _ints(docs), np.frombuffer(ends, np.int32), _ints(terms)
        n = int(ends[-1])
        at = np.frombuffer(at, {2: np.uint16, 4: np.uint32}[len(at) // n]).astype(np.intp)
        place = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return docs, np.diff(ends, prepend=0), place, self.terms[place] == terms, at, _wide(x, n).astype(np.float64)

    def weights(self, parts: tuple[int, ...] = (0,)) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """(G, what to multiply its rows with for ``parts`` that are normalised): G = X_b^T A,
        or the weights that were sent, a row for each term."""
        G = np.zeros((len(self.terms), self.k))
        sums = {p: np.zeros(len(self.terms)) for p in self.normalize if p in parts}
        for part, dc, places in self.chunks if len(self.terms) else []:
            moves = part == 0 and dc in self.sent
            if not moves and part not in sums:
                continue
            docs, sizes, place, known, at, x = self._chunk(places)
            if part in sums:
                sums[part][place[known]] += _sums(at, np.abs(x), len(place))[known]
            if moves:
                ids, a = (self._get(p) for p in self.sent[dc])
                a = _matrix(a, self.k)[np.searchsorted(_ints(ids), docs)]
                own = np.empty((len(place), self.k))
                for j in range(self.k):
                    own[:, j] = _sums(at, x * np.repeat(a[:, j], sizes), len(place))
                G[place] += own
        scale = {p: np.divide(1.0, s, out=np.zeros(len(s)), where=s != 0) for p, s in sums.items()}
        if 0 in scale:
            G *= scale[0][:, None]
        for ids, w in self.given if len(self.terms) else []:
            ids, w = _ints(self._get(ids)), _matrix(self._get(w), self.k)
            place = np.minimum(np.searchsorted(self.terms, ids), len(self.terms) - 1)
            known = self.terms[place] == ids
            G[place[known]] = w[known]
        return G, scale

    def scores(self) -> Iterator[dict]:
        """What the block adds to the scores of each chunk's documents."""
        G, scale = self.weights(tuple({0, *(c[0] for c in self.chunks)}))
        for part, dc, places in self.chunks if len(self.terms) else []:
            docs, sizes, place, known, at, x = self._chunk(places)
            own = G[place, :self.k - 1]
            if part in scale:
                own *= scale[part][place][:, None]
            own[~known] = 0.0                          # other terms have no weight
            z, starts = np.empty((len(docs), self.k - 1)), np.cumsum(sizes) - sizes
            for j, w in enumerate(np.ascontiguousarray(own.T)):
                z[:, j] = np.add.reduceat(x * w[at], starts)
            yield dict(part=part, dc=dc, docs=docs.tobytes(), z=z.tobytes())


def _scores_of(k: int, normalize: list[int]):
    def scores(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryFile() as file:
            block = _Block(file, k, normalize)
            block.fill(batches)
            for row in block.scores():
                yield pa.RecordBatch.from_pylist([row | {"tb": key[0].as_py()}], schema=_FLOW)
    return scores


def _term_weights(k: int, normalize: list[int]):
    names = ["tkey", *[f"w_{j}" for j in range(1, k + 1)]]

    def weights(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryFile() as file:
            block = _Block(file, k, normalize)
            block.fill(batches)
            G, _ = block.weights()
            for i in range(0, len(block.terms), TERMS_OUT):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.terms[i:i + TERMS_OUT]), *[pa.array(np.ascontiguousarray(G[i:i + TERMS_OUT, j])) for j in range(k)]], names=names)
    return weights


def _gather(k: int, first: bool):
    """The new Z: what all blocks give (in one order), and what is left of the start."""
    def gather(state: pa.Table, flow: pa.Table) -> pa.Table:
        order = [("part", "ascending"), ("tb", "ascending")]
        parts = flow.sort_by(order).to_pylist() if flow.num_rows else []
        rows = state.to_pylist()
        for r in rows:
            docs = _ints(r["docs"])
            z = np.frombuffer(r["z0"]).reshape(len(docs), k - 1).copy() if r["z0"] else np.zeros((len(docs), k - 1))
            for f in parts:
                if f["part"] == r["part"]:
                    z[np.searchsorted(docs, _ints(f["docs"]))] += np.frombuffer(f["z"]).reshape(-1, k - 1)
            r["z"] = z.tobytes()
            if first:
                r["z0"] = r["z"]
        return pa.Table.from_pylist(rows, schema=_STATE)
    return gather


def _pack_weights(k: int):
    """Rows of W to packed rows, a few for each block."""
    def pack(batches):
        for batch in batches:
            tb, key, *w = _columns([batch], "tb", "tkey", *[f"w_{j}" for j in range(1, k + 1)]) or [np.zeros(0)] * (k + 2)
            for b in np.unique(tb):
                own = np.flatnonzero(tb == b)
                yield pa.RecordBatch.from_pylist([dict(
                    tb=int(b), part=SENT_W, dc=-1, docs=key[own].tobytes(), x=np.stack(w, axis=1)[own].tobytes())], schema=_BLOCK)
    return pack


def _unpack(k: int, stable: bool):
    def unpack(batches):
        for batch in batches:
            for d, c, z in zip(*(batch.column(n) for n in ("docs", "classes", "z"))):
                docs, cls = _ints(d.as_buffer()), np.frombuffer(c.as_buffer(), np.int32)
                p = softmax(np.frombuffer(z.as_buffer()).reshape(len(docs), k - 1), stable)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs), pa.array(cls, mask=cls == 0), *[pa.array(np.ascontiguousarray(p[:, j])) for j in range(k)]],
                    names=["doc_id", "class_id", *[f"p_{j}" for j in range(1, k + 1)]])
    return unpack


@dataclass
class TermBlocks:
    """The cells of a training split (part 0) and of splits scored with it."""

    table: DataFrame
    docs: DataFrame
    labels: list[int]       # of the blocks
    groups: int             # of shares of the documents, a task of a step each
    k: int
    normalize: list[int]    # parts whose cells are counts to normalise

    @property
    def spark(self) -> SparkSession:
        return self.table.sparkSession

    def _meet(self, messages: DataFrame, fn, schema: str) -> DataFrame:
        """``fn`` of each block: its chunks where they lie, and what is sent to it."""
        none = F.lit(None).cast("binary")
        sent = messages.select("tb", "part", "dc", "docs", none.alias("ends"), none.alias("terms"), none.alias("at"), "x")
        return self.table.unionByName(sent.repartition(len(self.labels), "tb")).groupBy("tb").applyInArrow(fn, schema)

    def to_blocks(self, state: DataFrame) -> DataFrame:
        labels = F.array(*[F.lit(v).cast("bigint") for v in self.labels])
        return state.where("part = 0").select(
            F.explode(labels).alias("tb"), F.lit(SENT_A).alias("part"), "dc", "docs", F.col("a").alias("x"))

    def weights_to_blocks(self, W: DataFrame) -> DataFrame:
        cols = [f"w_{j}" for j in range(1, self.k + 1)]
        return (W.select(_slot("tkey", self.labels).alias("tb"), "tkey", *cols).repartition(len(self.labels), "tb")
                .mapInArrow(_pack_weights(self.k), BLOCK))

    def scored(self, state: DataFrame, messages: DataFrame, first: bool = False) -> DataFrame:
        """``state`` with the scores that ``messages`` give, a written table."""
        k, m = self.k, self.groups
        z = self._meet(messages, _scores_of(k, self.normalize), "part int, dc bigint, docs binary, z binary, tb bigint")
        out = state.repartition(m, "dc").groupBy("dc").cogroup(z.repartition(m, "dc").groupBy("dc")).applyInArrow(
            _gather(k, first), STATE)
        with few_rows_at_once(self.spark):
            return written_table(out, "run-state")


@dataclass(frozen=True)
class Run:
    """A training run: its blocks and state; ``start`` are the weights it began with
    (none: zeros), of which ``left`` is left."""

    blocks: TermBlocks
    state: DataFrame
    start: DataFrame | None = None
    left: float = 1.0

    def step(self, eta: float, lam: float, stable: bool = False) -> "Run":
        b, keep = self.blocks, 1.0 - eta * lam
        moved = self.state.mapInArrow(_advance(b.k, eta, lam, stable, keep), STATE)
        return replace(self, state=b.scored(moved, b.to_blocks(moved)), left=self.left * keep)

    def weights(self) -> DataFrame:
        """(tkey, w_1..w_k) for every term of the training split, a written table."""
        b, cols = self.blocks, [f"w_{j}" for j in range(1, self.blocks.k + 1)]
        W = b._meet(b.to_blocks(self.state), _term_weights(b.k, b.normalize), "tkey bigint, " + ", ".join(f"{c} double" for c in cols))
        if self.start is not None:
            kept = self.start.select("tkey", *[(F.col(c) * F.lit(self.left)).alias(c) for c in cols])
            W = kept.unionByName(W).groupBy("tkey").agg(*[F.sum(c).alias(c) for c in cols])
        with few_rows_at_once(b.spark):
            return written_table(W, "W")

    def probabilities(self, part: int, stable: bool = False) -> DataFrame:
        """(doc_id, class_id, p_1..p_k) of the documents of a part."""
        k = self.blocks.k
        return self.state.where(F.col("part") == part).select("docs", "classes", "z").mapInArrow(
            _unpack(k, stable), "doc_id bigint, class_id int, " + ", ".join(f"p_{j} double" for j in range(1, k + 1)))

    def release(self) -> None:
        """Delete the state, and let Spark delete the shuffles of finished steps: it does
        when the driver collects garbage, which may be after hundreds of steps."""
        release(self.state)
        gc.collect()
        self.blocks.spark.sparkContext._jvm.System.gc()


def build(parts: list[tuple[DataFrame, DataFrame, bool]], k: int, n_cells: int, n_terms: int, n_docs: int) -> TermBlocks:
    """``parts``: (cells(doc_id, tkey, x), rows(doc_id, class_id), whether the cells are
    counts to normalise) of the training split and of others; the cells and documents of
    all of them, at most, and the training split's terms."""
    spark = parts[0][0].sparkSession
    importable(spark)
    cores = spark.sparkContext.defaultParallelism
    n = max(cores, -(-n_cells // BLOCK_CELLS), -(-n_terms * (k + 4) * 8 // WEIGHT_BYTES))
    m = max(cores, -(-n_cells // (n * CHUNK_CELLS)), -(-n_docs * k * 8 // STATE_BYTES))
    groups, labels = max(cores, -(-m // GROUPED)), slots(spark, n)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(m))
    packed, rows = None, None
    for i, (c, r, _) in enumerate(parts):
        c = c.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "tkey", "x").select(
            F.pmod(F.xxhash64("tkey"), F.lit(n)).alias("tb"), F.lit(i).alias("part"), share.alias("dc"),
            "doc_id", "tkey", F.coalesce(F.col("x"), F.lit(0.0)).cast("double").alias("x"))
        r = (r.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.coalesce(F.max("class_id"), F.lit(0)).alias("class_id")).select(F.lit(i).alias("part"), "doc_id", "class_id"))
        packed, rows = (c, r) if packed is None else (packed.unionByName(c), rows.unionByName(r))

    def kept(df: DataFrame, key: str, name: str, buckets: int) -> DataFrame:      # dealt by key already
        name = f"bowline_{name}_{uuid.uuid4().hex[:12]}"
        (df.write.bucketBy(buckets, key).sortBy(key).option("path", work_path(spark, "bucketed", name))
           .option("parquet.block.size", 16 << 20).option("parquet.block.size.row.check.min", ROWS_AT_ONCE)
           .option("parquet.page.size.row.check.min", ROWS_AT_ONCE).option("parquet.enable.dictionary", "false").saveAsTable(name))
        return spark.table(name)

    pieces = packed.mapInArrow(_pack_pieces(labels, groups, PIECE_CELLS),
                               "tb bigint, part int, dg bigint, docs binary, shares binary, sizes binary, keys binary, x binary")
    chunks = pieces.repartition(n, "tb").groupBy("tb", "part", "dg").applyInArrow(_merge_pieces(2 * GROUPED * CHUNK_CELLS), BLOCK)
    docs = rows.withColumn("dc", share).repartition(groups, "dc").mapInArrow(_pack_docs(k), STATE)
    return TermBlocks(kept(chunks, "tb", "blocks", n), kept(docs, "dc", "run_docs", groups), labels, groups, k,
                      [i for i, p in enumerate(parts) if p[2]])


def begin(blocks: TermBlocks, W: DataFrame | None = None) -> Run:
    """A run before its first step, from zeros or from given weights."""
    if W is None:
        return Run(blocks, blocks.docs)
    return Run(blocks, blocks.scored(blocks.docs, blocks.weights_to_blocks(W), first=True), W)
