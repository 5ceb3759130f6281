"""Helpers shared by the operators: scratch tables in the shared checkpoint
folder, column naming, and connected components as DataFrame rounds."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.session import checkpoint_dir, importable  # noqa: F401

SLICE_ROWS = 512

# Of a Python worker: what an operator keeps between tasks, and how to let it go.
_HELD: dict[str, Callable[[], None]] = {}


def at_work(operator: str, release: Callable[[], None] | None = None) -> None:
    """Called where an operator works in a Python worker: what other operators keep
    in this process is released (workers are used again by later stages)."""
    for other in [o for o in _HELD if o != operator]:
        _HELD.pop(other)()
    if release:
        _HELD[operator] = release


class Scratch:
    """Written tables below the session's checkpoint folder. A table cuts the
    lineage: a lost executor rereads files instead of redoing earlier stages."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/bowline-llm/{label}-{uuid.uuid4().hex}"
        self.made = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a scratch table that nothing reads any more."""
        path = df._scratch_path
        jvm = self.spark._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hpath, True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that clashes with none of ``df`` (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def arrow_map(fn: Callable[[dict], dict], schema: pa.Schema):
    """A ``mapInArrow`` function from ``fn``, which gets a dict of Python lists
    (SLICE_ROWS rows at a time, so memory stays bounded) and returns columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                out = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                     for f in schema], schema=schema)

    return run


def hash_share(want: int, total: int, *cols) -> Column:
    """Condition that keeps about ``want`` of ``total`` rows by a hash of
    ``cols``, the same rows at every run: what a sort with a limit then sends to
    the driver is bounded however many tasks read the table."""
    share = min(1.0, want / max(1, total))
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) <= int(share * (1 << 30))


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): rows (id, component) for
    every id that has an edge to another id, component = smallest id reachable.

    Alternating large-star / small-star rounds. Each round is two aggregations
    with partial sums and two joins on the node id. One node may have very many
    larger neighbours: in the join that meets them both sides are plain shuffles of
    written tables, which adaptive execution can split. Behind it every node is
    keyed by its larger end and has few. The edges of each round are a written
    table, and only a count and a checksum come to the driver.
    """
    e = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "edges")
    before = _signature(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        lows = low = scratch.write(low, "low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every node keeps its edge towards the smallest neighbour it has seen.
        large = large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        nxt = scratch.write(small, "edges")
        after = _signature(nxt)
        scratch.drop(e)
        scratch.drop(lows)
        e = nxt
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
