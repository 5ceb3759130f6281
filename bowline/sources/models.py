"""Trained models as one committed artefact.

A bundle is a folder with the weights by term - so the dictionary is in it - and
the training column sums, and one manifest with the class names, the parameters
and the iteration. The manifest is written last and names the data it belongs to:
it is the only commit point. Whoever has the folder can score documents, in a
fresh application and without the training data.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.operators import logistic as L
from bowline.operators.evaluate import with_class_names
from bowline.sources.corpus import ClassSet, Corpus
from bowline.sources.tables import _hadoop, delete_path, publish_manifest, read_manifest, write_predictions

MANIFEST = "model.json"


@dataclass
class ModelBundle:
    spark: SparkSession
    path: str
    manifest: dict
    weights: DataFrame      # (tkey, term, colsum, w_1..w_k)

    @property
    def classes(self) -> ClassSet:
        return ClassSet(tuple(self.manifest["classes"]))

    @property
    def iteration(self) -> int:
        return self.manifest["iteration"]

    def dictionary(self) -> L.FeatureSplit:
        """The training split as far as other splits need it: its terms, and its
        column sums if it was normalised."""
        m = self.manifest
        sums = self.weights.where("colsum IS NOT NULL").select("term", "colsum") if m["normalize"] else None
        return L.FeatureSplit(self.weights, 0, 0, m["n_terms"], self.weights.select("tkey", "term"), m["bias_key"],
                              colsums=sums, bias_value=m["bias_value"], term_bytes=m["term_bytes"])

    def predict(self, corpus: Corpus, normalize: bool = False, norm_stats: str = "split",
                stable: bool = False) -> DataFrame:
        """(doc_id, class_id, predicted, predicted_name) of every document."""
        split = L.build_features(corpus, normalize, dictionary=self.dictionary(), norm_stats=norm_stats)
        k = len(self.manifest["classes"])
        W = self.weights.select("tkey", *[f"w_{j}" for j in range(1, k + 1)])
        return with_class_names(L.predictions(W, split, k, stable), self.classes.to_df(self.spark), ["predicted"])

    def write_predictions(self, corpus: Corpus, path: str, **how) -> str:
        """``id,class`` CSV below the run parameters."""
        m = self.manifest
        return write_predictions(self.predict(corpus, **how), path, eta=m["eta"], **{"lambda": m["lam"]},
                                 iter=m["iteration"])


class ModelStore:
    """The bundles of one run, by iteration."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def committed(self) -> list[int]:
        fs, root = _hadoop(self.spark, self.root)
        if not fs.exists(root):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(root)]
        return sorted(int(n[5:]) for n in names if n.startswith("iter=") and n[5:].isdigit()
                      and read_manifest(self.spark, f"{self.root}/{n}/{MANIFEST}"))

    def save(self, W: DataFrame, split: L.FeatureSplit, classes: ClassSet, iteration: int, eta: float, lam: float,
             normalize: bool) -> ModelBundle:
        """Write and commit one bundle; an iteration that another application
        committed first is returned as that one wrote it."""
        path = f"{self.root}/iter={iteration}"
        data = f"weights-{uuid.uuid4().hex[:12]}"
        terms = split.terms
        sums = split.colsums if normalize and split.colsums is not None else None
        table = L.with_terms(W.withColumn("key", F.col("tkey")), split).withColumnRenamed("key", "tkey")
        table = table.join(sums, "term", "left") if sums is not None else table.withColumn("colsum", F.lit(None).cast("double"))
        table.select("tkey", "term", "colsum", *[f"w_{j}" for j in range(1, classes.k + 1)]) \
             .write.parquet(f"{path}/{data}")
        manifest = {"data": data, "classes": list(classes.names), "iteration": iteration, "eta": eta, "lam": lam,
                    "normalize": normalize, "n_terms": split.n_terms, "bias_key": split.bias_key,
                    "key_type": terms.schema["tkey"].dataType.simpleString(), "bias_value": split.bias_value,
                    "term_bytes": split.term_bytes}
        held = publish_manifest(self.spark, f"{path}/{MANIFEST}", manifest)
        if held["data"] != data:
            delete_path(self.spark, f"{path}/{data}")
        return self.load(iteration)

    def load(self, iteration: int | None = None) -> ModelBundle:
        """The chosen or latest bundle."""
        done = self.committed()
        if not done or (iteration is not None and iteration not in done):
            raise ValueError(f"no committed model {'' if iteration is None else iteration}; there are {done}")
        path = f"{self.root}/iter={done[-1] if iteration is None else iteration}"
        m = read_manifest(self.spark, f"{path}/{MANIFEST}")
        cols = [f"tkey {m['key_type']}", "term string", "colsum double",
                *[f"w_{j} double" for j in range(1, len(m["classes"]) + 1)]]
        return ModelBundle(self.spark, path, m, self.spark.read.schema(", ".join(cols)).parquet(f"{path}/{m['data']}"))
