"""Document tables -> token rows and sparse term counts, and the class dictionary."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bowline.functions.text import lower_words, tokens
from bowline.session import importable


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def term_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, term, cnt) for every distinct token of every document.

    explode -> hash aggregate on (doc_id, term): the partial aggregate runs
    before the shuffle, and the shuffle key (doc_id, term) spreads even a
    document that holds a large share of all tokens over many reducers.
    """
    rows = balance(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return (rows.select("doc_id", F.explode(tokens("text")).alias("term"))
                .groupBy("doc_id", "term")
                .agg(F.count(F.lit(1)).alias("cnt")))


@dataclass(frozen=True)
class ClassSet:
    """The class dictionary: class_id = 1-based position of the name."""

    names: tuple[str, ...]

    @property
    def k(self) -> int:
        return len(self.names)

    def class_id(self, label: Column | str) -> Column:
        """Map a label column to its class_id (NULL when not in the dictionary)."""
        col = F.col(label) if isinstance(label, str) else label
        pos = F.array_position(F.array(*[F.lit(n) for n in self.names]), col.cast("string"))
        return F.when(pos > 0, pos.cast("int"))

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(i + 1, n) for i, n in enumerate(self.names)], "class_id int, name string")

    @staticmethod
    def from_labels(df: DataFrame, label_col: str) -> "ClassSet":
        """Distinct non-null labels, sorted by name. The k names come to the
        driver: a model has k numbers per term, so k is small next to the data."""
        rows = (df.select(F.col(label_col).cast("string").alias("name"))
                  .where(F.col("name").isNotNull())
                  .distinct()
                  .orderBy("name")
                  .collect())
        return ClassSet(tuple(r["name"] for r in rows))

    @staticmethod
    def from_df(classes: DataFrame) -> "ClassSet":
        """From a (class_id, name) table such as the label-file reader's output."""
        rows = classes.orderBy("class_id").collect()
        ids = [r["class_id"] for r in rows]
        if ids != list(range(1, len(ids) + 1)):
            raise ValueError("class ids must be 1..k without gaps")
        return ClassSet(tuple(r["name"] for r in rows))


class Corpus:
    """A set of documents as weighted cells (doc_id, class_id, term, cnt).

    Models only ever need sums over cells, so the partial aggregate before each
    shuffle collapses them; ``where`` filters on doc_id push down to the scan.
    """

    # All counts are positive and the cells of a row lie together: where only sums
    # over cells matter, they need not be merged by document first.
    additive = False

    def cells(self) -> DataFrame:  # (doc_id, class_id, term, cnt)
        raise NotImplementedError

    def scoring_cells(self) -> DataFrame:
        """cells() plus one (term NULL, cnt 0) row for documents without cells,
        so per-document aggregates see every document without a join."""
        raise NotImplementedError

    def docs(self) -> DataFrame:  # (doc_id, class_id, n_tokens)
        raise NotImplementedError

    def rows(self) -> DataFrame:  # (doc_id, class_id) - no text is read
        raise NotImplementedError

    def where(self, cond: Column) -> "Corpus":
        raise NotImplementedError

    def labelled(self) -> "Corpus":
        return self.where(F.col("class_id").isNotNull())

    def tf(self) -> DataFrame:
        """(doc_id, class_id, term, cnt) with one row per (document, term)."""
        return (self.cells().groupBy("doc_id", "class_id", "term")
                    .agg(F.sum("cnt").alias("cnt")))

    def vocabulary(self) -> DataFrame:
        """(term) distinct terms."""
        return self.cells().select("term").distinct()

    @property
    def spark(self) -> SparkSession:
        return self.rows().sparkSession


# Cells of a batch that a tokenising task hands on.
CELLS_OUT = 1 << 17


def _word_counts(empty: bool):
    """Rows of lower-cased texts to cells; with ``empty``, a row without words to a
    cell without a term."""
    def counted(batches):
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary())
            rows, terms, counts = [], [], []

            def out() -> pa.RecordBatch:
                at = pa.array(rows, pa.int32())
                return pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("class_id").take(at), pa.array(terms, pa.binary()).cast(pa.string()),
                     pa.array(counts, pa.int64())], names=["doc_id", "class_id", "term", "cnt"])

            for i, text in enumerate(texts):
                words = Counter(lower_words(text.as_py()))
                if empty and not words:
                    words = {None: 0}
                rows += [i] * len(words)
                terms += words.keys()
                counts += words.values()
                if len(rows) >= CELLS_OUT:
                    yield out()
                    rows, terms, counts = [], [], []
            if rows:
                yield out()
    return counted


def _word_totals(batches):
    for batch in batches:
        totals = [len(lower_words(t.as_py())) for t in batch.column("_text").cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("class_id"), pa.array(totals, pa.int64())],
                                         names=["doc_id", "class_id", "n_tokens"])


@dataclass
class TextCorpus(Corpus):
    """One row per document: (doc_id, class_id, _text), tokenised where tokens
    are needed; each row has one cell for each of its distinct tokens (rows that
    share a doc_id may repeat a term). ``rows()`` reads the scan as it is, without
    text."""

    base: DataFrame
    additive = True

    def _per_text(self, fn, *columns: T.StructField) -> DataFrame:
        """(doc_id, class_id, columns) that ``fn`` makes of each lower-cased text."""
        importable(self.base.sparkSession)
        text = F.lower(F.coalesce(F.col("_text"), F.lit(""))).alias("_text")
        ids = [T.StructField(n, self.base.schema[n].dataType) for n in ("doc_id", "class_id")]
        return balance(self.base).select("doc_id", "class_id", text).mapInArrow(fn, T.StructType([*ids, *columns]))

    def _counted(self, empty: bool) -> DataFrame:
        return self._per_text(_word_counts(empty), T.StructField("term", T.StringType()), T.StructField("cnt", T.LongType()))

    def where(self, cond: Column) -> "TextCorpus":
        return TextCorpus(self.base.where(cond))

    def docs(self) -> DataFrame:
        return self._per_text(_word_totals, T.StructField("n_tokens", T.LongType()))

    def rows(self) -> DataFrame:
        return self.base.select("doc_id", "class_id")

    def cells(self) -> DataFrame:
        return self._counted(False)

    def scoring_cells(self) -> DataFrame:
        return self._counted(True)


@dataclass
class CellCorpus(Corpus):
    """Pre-counted documents: cells (doc_id, class_id, term, cnt) with cnt > 0,
    and rows (doc_id, class_id) listing every document."""

    cell_frame: DataFrame
    row_frame: DataFrame

    def where(self, cond: Column) -> "CellCorpus":
        return CellCorpus(self.cell_frame.where(cond), self.row_frame.where(cond))

    def rows(self) -> DataFrame:
        return self.row_frame.select("doc_id", "class_id")

    def cells(self) -> DataFrame:
        return self.cell_frame.select("doc_id", "class_id", "term", F.col("cnt").cast("bigint").alias("cnt"))

    def scoring_cells(self) -> DataFrame:
        empty = self.row_frame.select("doc_id", "class_id", F.lit(None).cast(self.cell_frame.schema["term"].dataType)
                                 .alias("term"), F.lit(0).cast("bigint").alias("cnt"))
        return self.cells().unionByName(empty)

    def docs(self) -> DataFrame:
        lengths = self.cells().groupBy("doc_id").agg(F.sum("cnt").alias("n_tokens"))
        return (self.row_frame.join(lengths, "doc_id", "left")
                    .select("doc_id", "class_id", F.coalesce(F.col("n_tokens"), F.lit(0)).cast("bigint")
                            .alias("n_tokens")))


def corpus_from_table(df: DataFrame, classes: ClassSet | None = None,
                      label_col: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text") -> TextCorpus:
    """Build a Corpus from a (id, text[, label]) table."""
    if label_col is not None and classes is not None:
        class_id = classes.class_id(label_col)
    else:
        class_id = F.lit(None).cast("int")
    return TextCorpus(df.select(F.col(id_col).cast("bigint").alias("doc_id"), class_id.alias("class_id"),
                                F.col(text_col).alias("_text")))


# A scan shared by more tasks than this would plan longer than it tokenises.
MOST_SHARES = 32
SPLIT_BYTES = 128 * 1024 * 1024      # usual size of a Parquet row group, the least that a task can read


def scan_shares(df: DataFrame) -> int:
    """How many tasks should share each split of ``df``'s files so that all cores
    have work: 1 where there are splits enough (or no files)."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    splits = 0
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        splits += -(-path.getFileSystem(conf).getFileStatus(path).getLen() // SPLIT_BYTES)
        if splits >= spark.sparkContext.defaultParallelism:
            return 1
    return min(MOST_SHARES, -(-spark.sparkContext.defaultParallelism // splits)) if splits else 1


def balance(df: DataFrame) -> DataFrame:
    """``df`` with enough tasks for CPU-bound work, without moving a row.

    Tokenising is CPU-bound, so a scan of a few large row groups starves the
    cores. Then several tasks read the same split and each takes every n-th row of
    the file: reading a split again costs much less than tokenising it, no text is
    shuffled, and the shares are even whatever the keys are. Inputs with a split
    for every core are left as they are, as are frames that read no files.
    """
    shares = scan_shares(df)
    if shares == 1:
        return df
    columns = df.columns
    try:
        numbered = df.select("*", F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:      # rows of this source have no number
        numbered = df.withColumn("_row", F.xxhash64(*columns))
    parts = [numbered.where(F.pmod("_row", F.lit(shares)) == i).select(columns) for i in range(shares)]
    return reduce(DataFrame.unionAll, parts)
