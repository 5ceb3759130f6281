"""The stages against what each of them promises on its own input."""

import corpus_pipeline
from bowline.llm import decontam
from bowline.sources.corpus import read_table

from test_operators import brute_components

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = read_table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns, name
        assert out.exceptAll(docs).count() == 0, name
        if name == "near_dedup":
            found = brute_components({r.doc_id: r.text for r in docs.collect()}, width=5)
            assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, c in found.values()})
        if name == "decontamination":
            hits = decontam.benchmark_hits(spark, out, read_table(spark, SF, "benchmark"), "h_")
            assert hits.where("h_.n_hit > 0").count() == 0
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    whole = corpus_pipeline.run(spark, SF)
    cols = [c for c in packed.columns if c not in ("sequence_id", "offset")]
    assert sorted(map(tuple, whole.select(cols).collect())) == sorted(map(tuple, packed.select(cols).collect()))


def test_registered(spark):
    import __spark_entry__ as e

    names = e.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_stages_on_nulls_repeats_long_texts_and_clashing_names(spark, docs):
    """Every stage on the same awkward table: columns stay, rows are rows of the
    table, and none is made or lost beyond the stage's decision."""
    rows = sorted(map(str, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = sorted(map(str, out.collect()))
        assert set(got) <= set(rows), name
        if name == "language_id":          # null, empty and letterless texts go, with every copy
            assert not any(r.text is None or r.text in ("", "... 123") for r in out.collect())
        if name == "near_dedup":
            kept = [r.doc_id for r in out.collect()]
            # wordless texts and rows without an id stay; of copies the smallest id
            assert sorted(d for d in kept if d is not None) == [1, 3, 4, 5, 6, 7, 9] and kept.count(None) == 1
        if name == "decontamination":
            assert got == rows
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.where("piece = 0").count() == docs.count()


def test_stages_on_empty_tables(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), SF)
        assert out.count() == 0, name
        if name != "packing":
            assert out.columns == docs.columns, name
