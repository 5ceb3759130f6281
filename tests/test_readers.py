import os

import pytest

from bowline.sources import matrix as M
from bowline.sources import tables as T
from bowline.session import work_path


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_count_matrix_round_trip(spark, tmp_path):
    p = _write(tmp_path / "training.csv", "1,0,2,0,1\n2,3,0,0,2\n3,0,0,0,1\n")
    c = M.read_count_matrix(spark, str(p))
    cells = sorted(tuple(r) for r in c.cells().collect())
    assert cells == [(1, 1, 1, 2), (2, 2, 0, 3)]
    assert sorted(tuple(r) for r in c.docs().collect()) == [(1, 1, 2), (2, 2, 3), (3, 1, 0)]
    q = _write(tmp_path / "testing.csv", "9,1,0,4\n")
    t = M.read_count_matrix(spark, str(q), labelled=False)
    assert sorted(tuple(r) for r in t.cells().collect()) == [(9, None, 0, 1), (9, None, 2, 4)]


def test_count_matrix_malformed(spark, tmp_path):
    bad = _write(tmp_path / "bad.csv", "1,0,x,1\n")
    with pytest.raises(Exception):
        M.read_count_matrix(spark, str(bad)).cells().collect()
    short = _write(tmp_path / "short.csv", "1,0,2,1\n2,1\n")
    with pytest.raises(ValueError):
        M.read_count_matrix(spark, str(short))


def test_vocabulary_line_numbers(spark, tmp_path):
    words = [f"w{i:05d}" for i in range(2500)]
    p = _write(tmp_path / "vocabulary.txt", "\n".join(words) + "\n")
    got = {r["term_id"]: r["term"] for r in M.read_vocabulary(spark, str(p)).collect()}
    assert got == dict(enumerate(words))


def test_class_labels(spark, tmp_path):
    p = _write(tmp_path / "labels.txt", "1 alt.atheism\n2 comp.graphics\n")
    assert [tuple(r) for r in M.read_class_labels(spark, str(p)).orderBy("class_id").collect()] == \
        [(1, "alt.atheism"), (2, "comp.graphics")]
    bad = _write(tmp_path / "bad_labels.txt", "1 a b\n")
    with pytest.raises(Exception):
        M.read_class_labels(spark, str(bad)).collect()


def test_metrics_curve_best_beta(spark, tmp_path):
    from bowline.operators.evaluate import best_by_accuracy
    p = _write(tmp_path / "acc.csv", "beta,accuracy\n0.00001,0.86861\n0.0001,0.87392\n0.001,0.87983\n"
                                     "0.01,0.88514\n0.1,0.88012\n1.0,0.84174\n")
    acc = M.read_metrics(spark, str(p))
    assert [r["beta"] for r in acc.collect()] == [0.00001, 0.0001, 0.001, 0.01, 0.1, 1.0]
    assert best_by_accuracy(acc).first()["beta"] == 0.01


def test_load_or_build_reuses_committed_copy(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    key = os.urandom(4).hex()
    a = T.load_or_build(spark, "probe", build, key)
    b = T.load_or_build(spark, "probe", build, key)
    assert a.count() == b.count() == 5 and len(calls) == 1


def test_predictions_csv(spark):
    path = work_path(spark, "tests", "pred-" + os.urandom(4).hex())
    preds = spark.createDataFrame([(12001, 3), (12002, 1)], "doc_id long, predicted int")
    T.write_predictions(preds, path, beta=0.01)
    back = T.read_predictions(spark, path)
    assert sorted((r["id"], r["class"]) for r in back.collect()) == [(12001, 3), (12002, 1)]


def test_load_or_build_sees_overwritten_input_and_survives_the_process(spark, tmp_path):
    import subprocess
    import sys

    src, work = str(tmp_path / "src"), str(tmp_path / "work")
    spark.conf.set("bowline.workDir", work)
    try:
        built = []

        def count():
            df = spark.read.parquet(src)
            got = T.load_or_build(spark, "n", lambda: built.append(1) or df.groupBy().count(), "v1", source=df)
            return got.first()[0]

        spark.range(5).write.parquet(src)
        assert count() == 5 and count() == 5 and len(built) == 1
        # another application finds the copy: its builder must not run
        code = (f"from bowline.session import get_session; from bowline.sources import tables as T\n"
                f"s = get_session('local[1]'); s.conf.set('bowline.workDir', {work!r}); df = s.read.parquet({src!r})\n"
                f"print('N', T.load_or_build(s, 'n', lambda: 1 / 0, 'v1', source=df).first()[0])")
        run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200,
                             cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        assert "N 5" in run.stdout, run.stderr[-2000:]
        spark.range(50).write.mode("overwrite").parquet(src)
        assert count() == 50 and len(built) == 2
    finally:
        spark.conf.unset("bowline.workDir")


def test_snapshots_that_were_not_committed_are_ignored(spark, tmp_path):
    store = T.SnapshotStore(spark, str(tmp_path / "w"))
    assert store.table() is None and store.load() == (None, 0)
    store.save(spark.range(3), 2)
    half = tmp_path / "w" / "iter=9"
    half.mkdir()
    (half / "part-00000.parquet").write_bytes(b"half")
    assert store.committed() == [2] and store.latest() == 2 and store.load()[0].count() == 3


def test_count_matrix_width_checked_in_the_row(spark, tmp_path):
    short = _write(tmp_path / "short.csv", "1,0,2,1\n2,1\n")
    with pytest.raises(Exception, match="different widths"):
        M.read_count_matrix(spark, str(short), check_width="row").cells().collect()
    empty = _write(tmp_path / "empty.csv", "")
    assert M.read_count_matrix(spark, str(empty), check_width="row").cells().count() == 0


def test_count_matrix_written_and_read(spark):
    from bowline.sources.corpus import ClassSet, corpus_from_table
    rows = [(1, "b a b zzz", "x"), (2, "", "y"), (3, None, "x"), (4, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    vocabulary = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "term_id int, term string")
    path = work_path(spark, "tests", "matrix-" + os.urandom(4).hex())
    corpus = corpus_from_table(df, ClassSet(("x", "y")), "label")
    M.write_count_matrix(corpus, vocabulary, 3, path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["1,1,2,0,1", "2,0,0,0,2", "3,0,0,0,1"]
    M.write_count_matrix(corpus, vocabulary, 3, path, labelled=False)
    back = M.read_count_matrix(spark, path, labelled=False, check_width="row")
    assert sorted(map(tuple, back.cells().collect())) == [(1, None, 0, 1), (1, None, 1, 2), (4, None, 0, 1)]
    assert back.rows().count() == 4


def test_lines_follow_part_numbers(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for number in ("00002", "99999", "100000"):
        _write(folder / f"part-{number}-x.txt", f"w{number}\n")
    got = [r["term"] for r in M.read_vocabulary(spark, str(folder)).orderBy("term_id").collect()]
    assert got == ["w00002", "w99999", "w100000"]
