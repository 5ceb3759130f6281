"""Readers for the reference's text formats.

* count matrix: one document per line, ``id,c_1..c_V[,class]``, no header
* sparse count matrix: ``id class index:count index:count ..``, one line a
  document, class ``-`` where there is none; as wide as the vocabulary is, it
  holds only what is not zero
* vocabulary: one term per line; the 0-based line number is the column index
* class labels: ``<class_id> <name>`` per line
* metrics: CSV with header ``beta,accuracy``

Lines are parsed with ``split`` + ``posexplode`` in one stage and zero cells are
dropped before any shuffle. Casts run in ANSI mode, so a malformed number fails
the job. ``check_width=True`` refuses rows of unequal length before anything
else, in a pass of its own; ``"row"`` fails the reading job on a row that is not
as wide as the first one, without a second pass. The permissive readers set
malformed rows aside with a reason instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bowline.session import broadcast_limit_bytes
from bowline.sources.corpus import CellCorpus, Corpus
from bowline.sources.tables import written_table


def read_lines_numbered(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value): 0-based global line numbers of a text file or folder.

    Rows of one file split arrive in order and carry consecutive
    ``monotonically_increasing_id`` values (stable on recomputation: the file
    splits are fixed). Prefix sums in two levels give each split's offset: of the
    splits within their file, in parallel, and of the files, of which the driver
    holds a list anyway. Files that Spark wrote come in the order of their part
    numbers, others by name.
    """
    raw = spark.read.text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("block"),
        F.monotonically_increasing_id().alias("mid"), "value")
    blocks = written_table(raw.groupBy("file", "block").agg(F.min("mid").alias("first"), F.count(F.lit(1)).alias("n")),
                           "line-blocks")
    part = F.regexp_extract("file", r"/part-(\d+)[^/]*$", 1).try_cast("bigint")
    files = blocks.groupBy("file").agg(F.sum("n").alias("lines"), F.count(F.lit(1)).alias("splits")) \
        .withColumn("part", part).collect()
    before, starts = 0, []
    for f in sorted(files, key=lambda f: (f["part"] is not None, f["part"] or 0, f["file"])):
        starts.append((f["file"], before))
        before += f["lines"]
    within = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (blocks.withColumn("ahead", F.coalesce(F.sum("n").over(within), F.lit(0)))
               .join(_sized(spark.createDataFrame(starts, "file string, start bigint"), len(starts)), "file")
               .select("file", "block", "first", (F.col("start") + F.col("ahead")).alias("offset")))
    return (raw.join(_sized(offsets, sum(f["splits"] for f in files)), ["file", "block"])
               .select((F.col("offset") + F.col("mid") - F.col("first")).alias("line_no"), "value"))


def _sized(df: DataFrame, rows: int, row_bytes: int = 300) -> DataFrame:
    """``df`` for the small side of a join: broadcast while it is known to fit."""
    return F.broadcast(df) if rows * row_bytes <= broadcast_limit_bytes(df.sparkSession) else df


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(term_id INT, term STRING), term_id = 0-based line number (S3)."""
    return read_lines_numbered(spark, path).select(
        F.col("line_no").cast("int").alias("term_id"), F.rtrim(F.col("value")).alias("term"))


def read_class_labels(spark: SparkSession, path: str) -> DataFrame:
    """(class_id INT, name STRING) from ``<int> <name>`` lines.

    A line that does not have exactly two tokens fails the query."""
    parts = F.split(F.trim(F.col("value")), " ")
    rows = spark.read.text(path).where(F.trim(F.col("value")) != "").select(parts.alias("p"))
    checked = rows.select(
        F.when(F.size("p") == 2, F.col("p")).otherwise(
            F.raise_error(F.concat(F.lit("label line must be '<id> <name>': "), F.array_join("p", " "))))
        .alias("p"))
    return checked.select(F.col("p")[0].cast("int").alias("class_id"), F.col("p")[1].alias("name"))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(beta DOUBLE, accuracy DOUBLE) ordered by beta."""
    return (spark.read.option("header", True).schema("beta double, accuracy double").csv(path)
                 .orderBy("beta"))


def read_count_matrix(spark: SparkSession, path: str, labelled: bool = True,
                      check_width: bool | str = True) -> CellCorpus:
    """Count-matrix text -> CellCorpus with term = 0-based column index.

    The unlabelled form (test file) has no class column.
    """
    lines = spark.read.text(path).where(F.trim(F.col("value")) != "")
    arr = lines.select(F.split(F.col("value"), ",").alias("a"))
    if check_width == "row":
        first = arr.select(F.size("a")).first()
        if first is not None:
            width = F.lit(first[0])
            arr = arr.select(F.when(F.size("a") == width, F.col("a")).otherwise(F.raise_error(F.concat(
                F.lit("count matrix rows have different widths: "), width.cast("string"), F.lit(" and "),
                F.size("a").cast("string")))).alias("a"))
    elif check_width:
        w = arr.agg(F.min(F.size("a")).alias("lo"), F.max(F.size("a")).alias("hi")).first()
        if w["lo"] is not None and w["lo"] != w["hi"]:
            raise ValueError(f"count matrix rows have different widths ({w['lo']} .. {w['hi']})")
    doc_id = F.trim(F.col("a")[0]).cast("bigint")
    class_id = F.trim(F.element_at("a", -1)).cast("int") if labelled else F.lit(None).cast("int")
    n_cells = F.size("a") - (2 if labelled else 1)
    base = arr.select(doc_id.alias("doc_id"), class_id.alias("class_id"),
                      F.slice("a", 2, n_cells).alias("cells"))
    rows = base.select("doc_id", "class_id")
    cells = (base.select("doc_id", "class_id", F.posexplode("cells").alias("term", "raw"))
                 .select("doc_id", "class_id", F.col("term").cast("int").alias("term"),
                         F.trim(F.col("raw")).cast("bigint").alias("cnt"))
                 .where(F.col("cnt") != 0))
    return CellCorpus(cells, rows)


def write_count_matrix(corpus: Corpus, vocabulary: DataFrame, n_terms: int, path: str, labelled: bool = True) -> str:
    """``corpus`` as count-matrix text with one column per row of ``vocabulary``
    (term_id 0..n_terms-1, term); terms outside it have no column. A line holds
    ``n_terms`` numbers, so this is for narrow vocabularies."""
    corpus = corpus.labelled() if labelled else corpus
    counted = (corpus.tf().join(vocabulary.select("term", "term_id"), "term").groupBy("doc_id")
                     .agg(F.map_from_entries(F.collect_list(F.struct("term_id", "cnt"))).alias("m")))
    cells = F.transform(F.sequence(F.lit(0), F.lit(n_terms - 1)),
                        lambda i: F.coalesce(F.col("m")[i.cast("int")], F.lit(0)).cast("string"))
    fields = [F.col("doc_id").cast("string"), F.concat_ws(",", cells)]
    if labelled:
        fields.append(F.col("class_id").cast("string"))
    lines = corpus.rows().join(counted, "doc_id", "left").select(F.concat_ws(",", *fields).alias("value"))
    lines.write.mode("overwrite").text(path)
    return path


@dataclass
class MatrixScan:
    """What a permissive reader made of a file (Q12): the rows that parse, and
    the others as (value, reason)."""

    corpus: CellCorpus
    rejects: DataFrame

    def counts(self) -> DataFrame:
        """(reason, n): rows by reason; those that were read have none."""
        read = self.corpus.rows().agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("string").alias("reason"), "n")
        return read.unionByName(self.rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def _cells_of(rows: DataFrame, pairs: Column) -> CellCorpus:
    """``rows(doc_id, class_id, ..)`` and their cells, ``pairs`` being an array of
    (term, cnt); zero cells are dropped."""
    cells = rows.select("doc_id", "class_id", F.inline(pairs)).where(F.col("cnt") != 0)
    return CellCorpus(cells, rows.select("doc_id", "class_id"))


def _scan(lines: DataFrame, problem: Column, doc_id: Column, class_id: Column, pairs: Column) -> MatrixScan:
    judged = lines.withColumn("reason", problem)
    good = judged.where("reason IS NULL").select("*", doc_id.alias("doc_id"), class_id.alias("class_id"))
    return MatrixScan(_cells_of(good, pairs), judged.where("reason IS NOT NULL").select("value", "reason"))


def _is_number(raw: Column, kind: str = "bigint") -> Column:
    return F.trim(raw).try_cast(kind).isNotNull()


def scan_count_matrix(spark: SparkSession, path: str, width: int, labelled: bool = True) -> MatrixScan:
    """The dense matrix of ``width`` count columns, malformed rows set aside:
    ``width`` (fields missing or too many), ``id``, ``class`` or ``count``."""
    lines = spark.read.text(path).where(F.trim(F.col("value")) != "").withColumn("a", F.split("value", ","))
    class_raw = F.element_at("a", -1) if labelled else F.lit("0")
    raw = F.slice("a", 2, width)
    problem = (F.when(F.size("a") != width + 1 + int(labelled), "width").when(~_is_number(F.col("a")[0]), "id")
               .when(~_is_number(class_raw, "int"), "class").when(~F.forall(raw, lambda c: _is_number(c)), "count"))
    pairs = F.transform(raw, lambda c, i: F.struct(i.cast("int").alias("term"), F.trim(c).cast("bigint").alias("cnt")))
    class_id = F.trim(class_raw).cast("int") if labelled else F.lit(None).cast("int")
    return _scan(lines, problem, F.trim(F.col("a")[0]).cast("bigint"), class_id, pairs)


def write_sparse_matrix(corpus: Corpus, vocabulary: DataFrame, path: str) -> str:
    """``corpus`` as sparse count-matrix text over all of ``vocabulary(term_id,
    term)``; a line holds one document's nonzero counts in column order. Cells get
    their column before they move: by document, once, as numbers."""
    terms = _sized(vocabulary.select("term", "term_id"), vocabulary.count(), 80)
    dealt = corpus.cells().join(terms, "term").select("doc_id", "class_id", "term_id", "cnt").repartition("doc_id")
    counted = (dealt.groupBy("doc_id", "class_id", "term_id").agg(F.sum("cnt").alias("cnt")).groupBy("doc_id")
               .agg(F.sort_array(F.collect_list(F.struct("term_id", "cnt"))).alias("cells")))
    cells = F.transform("cells", lambda c: F.concat(c["term_id"].cast("string"), F.lit(":"), c["cnt"].cast("string")))
    line = F.concat_ws(" ", F.col("doc_id").cast("string"), F.coalesce(F.col("class_id").cast("string"), F.lit("-")), cells)
    corpus.rows().join(counted, "doc_id", "left").select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def _judge_sparse(spark: SparkSession, path: str) -> DataFrame:
    """(value, reason, doc_id, class_id, cells) of every line; a cell is split once."""
    lines = spark.read.text(path).where(F.trim(F.col("value")) != "").withColumn("a", F.split(F.trim("value"), " +"))
    class_raw = F.get("a", F.lit(1))
    raw = F.slice("a", 3, F.greatest(F.size("a") - 2, F.lit(0)))
    cell = lambda h: F.struct(
        F.when(F.size(h) == 2, F.trim(h[0]).try_cast("int")).alias("term"), F.trim(F.get(h, F.lit(1))).try_cast("bigint").alias("cnt"))
    read = lines.select("value", "a", F.transform(F.transform(raw, lambda c: F.split(c, ":")), cell).alias("cells"))
    problem = (F.when(F.size("a") < 2, "fields").when(~_is_number(F.col("a")[0]), "id")
               .when(~(_is_number(class_raw, "int") | (class_raw == "-")), "class")
               .when(F.exists("cells", lambda c: c["term"].isNull() | c["cnt"].isNull()), "count"))
    return read.select("value", problem.alias("reason"), F.trim(F.col("a")[0]).try_cast("bigint").alias("doc_id"),
                       F.when(class_raw != "-", F.trim(class_raw).try_cast("int")).alias("class_id"), "cells")


def scan_sparse_matrix(spark: SparkSession, path: str) -> MatrixScan:
    """The sparse matrix, malformed rows set aside: ``fields`` (no class field),
    ``id``, ``class`` or ``count`` (a cell that is not index:count). The lines are
    parsed once, into a written table that everything asked of the scan reads."""
    judged, good = _judge_sparse(spark, path), F.col("reason").isNull()
    kept = written_table(judged.select("reason", F.when(~good, F.col("value")).alias("value"), "doc_id", "class_id",
                                       F.when(good, F.col("cells")).alias("cells")), "matrix-scan")
    return MatrixScan(_cells_of(kept.where(good), F.col("cells")), kept.where(~good).select("value", "reason"))


def read_sparse_matrix(spark: SparkSession, path: str) -> CellCorpus:
    """The sparse matrix; a malformed row fails the job that reads it."""
    judged, good = _judge_sparse(spark, path), F.col("reason").isNull()
    broken = F.raise_error(F.concat(F.lit("malformed count-matrix row ("), F.col("reason"), F.lit("): "), F.col("value")))
    row = F.when(good, F.struct("doc_id", "class_id", "cells")).otherwise(broken)
    cells = (judged.select(row.alias("row")).select("row.doc_id", "row.class_id", F.inline("row.cells"))
             .where(F.col("cnt") != 0))
    rows = judged.where(F.when(good, F.lit(True)).otherwise(broken.cast("boolean")))
    return CellCorpus(cells, rows.select("doc_id", "class_id"))
