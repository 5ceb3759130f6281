from collections import Counter

import pytest
from pyspark.sql import functions as F

from bowline.functions.text import tokens
from bowline.operators.split import kth_smallest, ordered_split
from bowline.sources.corpus import TextCorpus, balance, scan_shares, term_counts


def test_tokens_rule(spark):
    df = spark.createDataFrame([(1, "Hello, WORLD!! a1b2--x"), (2, ""), (3, None), (4, "éclair café")],
                               "doc_id long, text string")
    got = {r["doc_id"]: r["t"] for r in df.select("doc_id", tokens("text").alias("t")).collect()}
    assert got[1] == ["hello", "world", "a1b2", "x"]
    assert got[2] == [] and got[3] == []
    assert got[4] == ["clair", "caf"]


def test_term_counts_match_counter(spark):
    texts = ["b a b c b", "x", "", "Aa aa AA b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["term"]): r["cnt"] for r in term_counts(df).collect()}
    want = {}
    import re
    for i, t in enumerate(texts):
        for term, c in Counter(x for x in re.split("[^a-z0-9]+", t.lower()) if x).items():
            want[(i, term)] = c
    assert got == want


def test_ordered_split_matches_sorting(spark):
    ids = [5, 3, 1000000007, -4, 17, 8, 2 ** 40, 9, 11, 12, 13]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    info = ordered_split(df, 0.2)
    n_val = int(0.2 * len(ids))
    s = sorted(ids)
    assert info.n_train == len(ids) - n_val
    assert info.boundary == s[len(ids) - n_val]
    train = [r["doc_id"] for r in df.where(info.train()).collect()]
    assert sorted(train) == s[: len(ids) - n_val]


def test_kth_smallest_every_position(spark):
    ids = [7, 1, 99, 42, 3, 64, 5, 1 << 50, -(1 << 45)]
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    lo, hi = min(ids), max(ids)
    for pos in range(len(ids)):
        assert kth_smallest(df, "k", pos, lo, hi) == (sorted(ids)[pos], pos)


def test_split_without_validation(spark):
    df = spark.createDataFrame([(1,), (2,)], "doc_id long")
    info = ordered_split(df, 0.2)
    assert info.boundary is None and df.where(info.train()).count() == 2
    assert df.where(info.validation()).count() == 0


def test_split_with_null_and_repeated_keys(spark):
    from bowline.operators.split import ordered_split

    for keys, frac in (([1, 2, 2, 2, 2], 0.4), ([None, 3, 1, 2, None], 0.4), ([None, 1, 2], 0.0), ([5] * 9, 0.5)):
        df = spark.createDataFrame([(k,) for k in keys], "doc_id long")
        s = ordered_split(df, frac)
        assert df.where(s.train()).count() == s.n_train and df.where(s.validation()).count() == s.n_validation
        assert s.n_train + s.n_validation == s.n == sum(k is not None for k in keys)
        labels = {r[0]: r[1] for r in df.select("doc_id", s.label()).collect()}
        assert None not in keys or labels[None] is None


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_a_scan_of_one_split_is_shared_without_moving_text(spark, tmp_path, kind):
    """Every task takes its rows of the same split: no exchange, even shares
    whatever the ids are, every row once."""
    path = str(tmp_path / "docs")
    rows = spark.range(2000).select((F.col("id") % 3).alias("doc_id"), F.lit(None).cast("int").alias("class_id"),
                                    F.concat(F.lit("word "), F.col("id").cast("string")).alias("_text"))
    rows.coalesce(1).write.format(kind).save(path)
    back = spark.read.schema(rows.schema).format(kind).load(path)
    assert scan_shares(back) == spark.sparkContext.defaultParallelism
    out = balance(back.where("doc_id < 2"))
    want = rows.where("doc_id < 2")
    assert out.columns == rows.columns
    assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) < 2 * 1334 / len(sizes)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    plan = TextCorpus(back).cells().groupBy("term").count()._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan


def test_frames_without_files_are_left_alone(spark):
    df = spark.range(5).select(F.col("id").alias("doc_id"))
    assert scan_shares(df) == 1 and balance(df) is df


def test_cells_come_counted_and_tokenised_as_the_column_rule(spark):
    """A row gives one cell for each distinct token, not one for each occurrence."""
    from bowline.functions.text import tokens
    from pyspark.sql import functions as F
    rows = [(1, 1, "B a b  b\tA-1 a1"), (2, None, None), (3, 2, "İx K9 naïve 中文z"), (3, 2, "x x"), (None, 1, "q\x00q")]
    df = spark.createDataFrame(rows, "doc_id long, class_id int, _text string")
    corpus = TextCorpus(df)
    assert sorted((r["term"], r["cnt"]) for r in corpus.cells().where("doc_id = 1").collect()) == [("1", 1), ("a", 2), ("a1", 1), ("b", 3)]
    want = df.select("doc_id", "class_id", F.explode(tokens("_text")).alias("term")).groupBy("doc_id", "class_id", "term").count()
    assert sorted(map(str, corpus.tf().collect())) == sorted(str(r).replace("count=", "cnt=") for r in want.collect())
    empty = [tuple(r) for r in corpus.scoring_cells().where("term IS NULL").collect()]
    assert empty == [(2, None, None, 0)]
    assert sorted(r["n_tokens"] for r in corpus.docs().collect()) == [0, 2, 2, 6, 7]
