"""Written tables in the shared checkpoint folder: load-or-build (S6),
prediction CSVs (K1), ranked-word text (K2) and model snapshots (K3, L7).

Commit: what several applications may write is written aside, under a name of its
own, and becomes visible by one rename that fails where the target exists. A
reader finds either nothing or all of it, and the loser of a race reads what the
winner wrote.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.session import durable_path, work_path


def _hadoop(spark: SparkSession, path: str):
    """(file system, Hadoop path) of ``path``."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop(spark, path)
    fs.delete(hpath, True)


def publish(spark: SparkSession, aside: str, path: str) -> bool:
    """Rename ``aside`` to ``path`` unless that exists; whether it was done. What
    was not published is deleted."""
    sc = spark.sparkContext
    fs, target = _hadoop(spark, path)
    source = _hadoop(spark, aside)[1]
    fs.mkdirs(target.getParent())
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(target).toUri(), sc._jsc.hadoopConfiguration())
    options = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), options)
        return True
    except Exception:
        if not fs.exists(target):
            raise
        fs.delete(source, True)
        return False


def publish_manifest(spark: SparkSession, path: str, content: dict) -> dict:
    """Commit ``content`` as the JSON file ``path``; what the file holds then (of
    a faster writer, if there was one)."""
    aside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    fs, hpath = _hadoop(spark, aside)
    out = fs.create(hpath, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    return content if publish(spark, aside, path) else read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    fs, hpath = _hadoop(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _files_fingerprint(source: DataFrame) -> list[str]:
    """Path, length and modification time of every file the plan reads (file
    metadata only), and the plan without its per-session expression numbers."""
    spark = source.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in sorted(source.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        st = path.getFileSystem(conf).getFileStatus(path)
        out.append(f"{name} {st.getLen()} {st.getModificationTime()}")
    plan = source._jdf.queryExecution().analyzed().canonicalized().toString()
    return [*out, re.sub(r"#\d+L?", "", plan)]


def load_or_build(spark: SparkSession, name: str, build, *key_parts, source: DataFrame | None = None) -> DataFrame:
    """Read the Parquet table for (name, key) when a committed copy exists, else
    build it, write it, commit it and read it back. Of two applications that
    build one key, both read the copy that was committed first.

    The key covers the parameters and, when given, the source's files (path,
    length, modification time) and plan: an overwritten input is built again,
    and a later application finds the copy of an unchanged one. ``key_parts``
    have to name what else ``build`` depends on (its version, for one).
    """
    parts = [repr(p) for p in key_parts] + (_files_fingerprint(source) if source is not None else [])
    key = hashlib.sha256("|".join(parts).encode()).hexdigest()[:32]
    base = durable_path(spark, "tables", f"{name}-{key}")
    held = read_manifest(spark, f"{base}/committed.json")
    if held is None:
        data = f"data-{uuid.uuid4().hex[:12]}"
        build().write.parquet(f"{base}/{data}")
        held = publish_manifest(spark, f"{base}/committed.json", {"data": data})
        if held["data"] != data:
            delete_path(spark, f"{base}/{data}")
    return spark.read.parquet(f"{base}/{held['data']}")


def write_predictions(preds: DataFrame, path: str, id_col: str = "doc_id",
                      class_col: str = "predicted", **run_params) -> str:
    """CSV ``id,class`` with header; run parameters (beta, eta, ...) become
    partition columns so runs never overwrite each other."""
    out = preds.select(F.col(id_col).alias("id"), F.col(class_col).alias("class"),
                       *[F.lit(v).alias(k) for k, v in run_params.items()])
    w = out.write.mode("overwrite").option("header", True)
    if run_params:
        w = w.partitionBy(*run_params.keys())
    w.csv(path)
    return path


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(id, class, <run parameters>) of the prediction CSVs below ``path``; the
    two columns have a fixed schema, so no file is read ahead."""
    return spark.read.option("header", True).schema("id bigint, class int").csv(path)


def write_lines(lines: DataFrame, path: str) -> str:
    """Text sink, one line per row (K2 ranked words, label files). Part files
    keep the partition order, so a sorted frame reads back in order."""
    lines.write.mode("overwrite").text(path)
    return path


class SnapshotStore:
    """W snapshots as Parquet under ``<root>/iter=<n>``.

    The next snapshot number is the highest on disk plus the iterations since
    (the reference's cumulative numbering); loading defaults to the latest.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @staticmethod
    def for_run(spark: SparkSession, normalization: str, eta: float, lam: float, run: str) -> "SnapshotStore":
        """The store of a named run; a later application that names the same
        run and parameters resumes from it."""
        return SnapshotStore(spark, durable_path(spark, "models", run, normalization, f"eta={eta},lambda={lam}"))

    def committed(self) -> list[int]:
        """Numbers of the completely written snapshots, in order."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(root)]
        return sorted(int(n[5:]) for n in names if re.fullmatch(r"iter=\d+", n)
                      and _exists(self.spark, f"{self.root}/{n}/_SUCCESS"))

    def table(self) -> DataFrame | None:
        paths = [f"{self.root}/iter={n}" for n in self.committed()]
        return self.spark.read.option("basePath", self.root).parquet(*paths) if paths else None

    def latest(self) -> int:
        return max(self.committed(), default=0)

    def save(self, W: DataFrame, iterations: int) -> int:
        """The snapshot's number. It is written aside and renamed, so nobody reads
        half of it; where another run committed that number first, that stays."""
        n = self.latest() + iterations
        aside = f"{self.root}/.{uuid.uuid4().hex}"
        W.write.parquet(aside)
        publish(self.spark, aside, f"{self.root}/iter={n}")
        return n

    def load(self, iteration: int | None = None) -> tuple[DataFrame | None, int]:
        """(W, iter) for the chosen or latest snapshot; (None, 0) when empty."""
        done = self.committed()
        if not done:
            return None, 0
        it = iteration if iteration is not None else done[-1]
        if it not in done:
            raise ValueError(f"no complete snapshot {it}; there are {done}")
        return self.spark.read.parquet(f"{self.root}/iter={it}"), it


def bucketed_table(df: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table bucketed and sorted by ``key`` in the
    shared checkpoint folder and return a scan of it.

    Later aggregates by ``key`` and joins between tables bucketed the same way
    run without an exchange, and the written files cut the lineage (they
    survive lost executors). The table is external: its files live under the
    checkpoint folder, the session catalog only holds the bucketing metadata.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"bowline_{name}_{uuid.uuid4().hex[:12]}"
    path = work_path(spark, "bucketed", table)
    (df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key)
       .option("path", path).saveAsTable(table))
    out = spark.table(table)
    out._written, out._buckets = (table, path), n
    return out


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and scan it back
    (cuts lineage; the files survive lost executors)."""
    spark = df.sparkSession
    path = work_path(spark, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = (None, path)
    return out


def release(df: DataFrame) -> None:
    """Delete the files (and the catalog entry) of a ``written_table`` or
    ``bucketed_table`` that nothing reads any more; other frames are left alone."""
    table, path = getattr(df, "_written", (None, None))
    if table:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    if path:
        delete_path(df.sparkSession, path)
