"""Classify documents as they arrive (Structured Streaming).

Each micro-batch is a set of whole documents, so the batch classification plan
applies to it unchanged inside ``foreachBatch``; the fitted model (a written
counts table plus k class totals) is the static side. Output of an epoch
overwrites its own ``epoch=<id>`` folder, so a replayed batch after a failure
leaves exactly one copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bowline.operators.naive_bayes import NaiveBayesModel, nb_predict
from bowline.sources.corpus import corpus_from_table


def score_stream(model: NaiveBayesModel, stream: DataFrame, sink_path: str, checkpoint_location: str,
                 id_col: str = "doc_id", text_col: str = "text", vocab: str = "shared",
                 available_now: bool = False) -> StreamingQuery:
    """Start a query writing (doc_id, predicted) Parquet rows per micro-batch."""

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        corpus = corpus_from_table(batch, id_col=id_col, text_col=text_col)
        preds = nb_predict(model, corpus, vocab).select("doc_id", "predicted")
        preds.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/epoch={epoch_id}")

    writer = (stream.select(F.col(id_col), F.col(text_col)).writeStream
              .foreachBatch(run_batch).option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
