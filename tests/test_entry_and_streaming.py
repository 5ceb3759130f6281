import os
import time

import duckdb
import pytest

import __spark_entry__ as E
from bowline.operators.naive_bayes import nb_predict
from bowline.plans.workload import Workload
from bowline.session import work_path
from bowline.streaming import score_stream

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "class_id", "predicted"]
    assert df.count() == 40


def test_registry_keys_consistent():
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 30


def test_every_query_of_the_core_has_an_oracle():
    from bowline.plans.registry import all_oracles, all_queries
    # a run to the stopping rule is compared with NumPy instead (test_scale.py)
    assert set(all_queries()) - set(all_oracles()) == {"lr_train_to_stop"} and set(all_oracles()) < set(all_queries())
    assert len(all_queries()) == 52


@pytest.mark.parametrize("key", ["scan_count_matrix", "matrix_word_ranking", "named_predictions",
                                 "named_confusion_matrix", "split_tables", "ranked_words_text",
                                 "lr_write_predictions", "confusion_matrix_train", "uncertain_validation_documents"])
def test_written_and_named_results_match_oracle(spark, key):
    test_queries_match_oracle_small(spark, key)


@pytest.mark.parametrize("key", ["term_counts", "nb_classify", "confusion_matrix_nb", "word_ranking", "lr_train"])
def test_queries_match_oracle_small(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[key](spark, SF)
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    sorder = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    a = sorted(tuple(repr(r[i]) for i in sorder) for r in df.collect())
    b = sorted(tuple(repr(r[i]) for i in order) for r in res.fetchall())
    assert a == b


def test_streaming_scoring_equals_batch(spark, tmp_path):
    w = Workload.of(spark, SF)
    model = w.nb_model("lang", part="all", with_benchmark=True)
    src = str(tmp_path / "incoming")
    bench = w.table("benchmark")
    bench.limit(20).write.parquet(src + "/a")
    stream = spark.readStream.schema(bench.schema).parquet(src + "/a")
    sink = work_path(spark, "tests", "stream-" + os.urandom(4).hex())
    q = score_stream(model, stream, sink, sink + "_ckpt", id_col="item_id", available_now=True)
    q.awaitTermination(120)
    got = {r["doc_id"]: r["predicted"] for r in spark.read.parquet(sink).collect()}
    want = {r["doc_id"]: r["predicted"] for r in nb_predict(model, w.benchmark()).collect()}
    assert got and all(want[d] == p for d, p in got.items())
