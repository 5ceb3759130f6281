import pytest


@pytest.fixture(autouse=True)
def _workers_find_the_package(spark):
    from bowline.llm.common import importable

    importable(spark)


@pytest.fixture
def docs(spark):
    """Nulls, empty and very long texts, repeated rows, clashing extra columns."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, "en", "a"), (2, base + " tail", "en", "a"), (3, None, "en", None), (4, "", None, "b"),
            (5, "one", "fr", "b"), (6, "... 123", "fr", "a"), (7, "lorem " * 30000, "en", "a"), (1, base, "en", "a"),
            (None, base, "en", "a"), (8, "ONE", None, "c"), (9, " ".join(f"z{i}" for i in range(60)), "fr", "c")]
    out = [(*r, 0, "x", 0.0, 0, False) for r in rows]
    return spark.createDataFrame(out, "doc_id long, text string, lang string, source string, kept int, hits string, "
                                      "score double, n_tokens int, language boolean")
