"""op8: texts reach the network in pieces, and no row waits in the executor."""

from bowline.llm import bytecnn_lang
from bowline.llm.common import SLICE_ROWS


def test_scoring_keeps_no_queue_of_rows(spark):
    docs = spark.createDataFrame([(i, "the house and the garden" if i % 2 else "das Haus und der Garten", "en" if i % 2 else "de")
                                  for i in range(3 * SLICE_ROWS)], "doc_id long, text string, lang string").coalesce(1)
    got = bytecnn_lang.identify_languages(spark, docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.schema["doc_id"].dataType.simpleString() == "bigint"
    assert sorted(r.doc_id for r in got.collect()) == list(range(3 * SLICE_ROWS))
