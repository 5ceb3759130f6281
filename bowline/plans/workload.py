"""Per-dataset context: corpora, class dictionaries, the split and fitted models,
computed once per (session, data folder) and reused by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.operators import logistic as lr
from bowline.operators.naive_bayes import NaiveBayesModel, nb_fit
from bowline.operators.split import SplitInfo, ordered_split
from bowline.sources.corpus import ClassSet, TextCorpus, corpus_from_table, read_table

VALIDATION_SPLIT = 0.2

# Fixed query parameters for the logistic-regression keys: the reference's
# defaults (eta 0.01, lambda 0.005, normalised features) and a plain-count
# variant with a small step so exp() stays finite.
LR_NORMALISED = dict(normalize=True, eta=0.01, lam=0.005)
LR_PLAIN = dict(normalize=False, eta=1e-7, lam=0.005)
LR_LABEL = "lang"
LR_STEPS = 3

_CONTEXTS: dict[tuple, "Workload"] = {}


class Workload:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict = {}

    @staticmethod
    def of(spark: SparkSession, sf_dir: str) -> "Workload":
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in _CONTEXTS or _CONTEXTS[key].spark is not spark:
            _CONTEXTS[key] = Workload(spark, sf_dir)
        return _CONTEXTS[key]

    def _memo(self, key, fn):
        if key not in self._cache:
            self._cache[key] = fn()
        return self._cache[key]

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def classes(self, label: str) -> ClassSet:
        return self._memo(("classes", label), lambda: ClassSet.from_labels(self.table("documents"), label))

    def corpus(self, label: str | None) -> TextCorpus:
        if label is None:
            return corpus_from_table(self.table("documents"))
        return corpus_from_table(self.table("documents"), self.classes(label), label)

    def benchmark(self) -> TextCorpus:
        return corpus_from_table(self.table("benchmark"), id_col="item_id")

    def split(self) -> SplitInfo:
        return self._memo("split", lambda: ordered_split(self.table("documents"), VALIDATION_SPLIT, "doc_id"))

    def train(self, label: str) -> TextCorpus:
        return self.corpus(label).where(self.split().train())

    def validation(self, label: str) -> TextCorpus:
        return self.corpus(label).where(self.split().validation())

    def nb_model(self, label: str, part: str = "train", with_benchmark: bool = False) -> NaiveBayesModel:
        """Fitted on the training split (``part='train'``, vocabulary = all
        documents) or on all documents (vocabulary = documents, plus the
        benchmark items with ``with_benchmark``)."""
        def fit():
            data, extra = self.corpus(label), []
            if part == "train":  # one scan: a validation document gives terms but has no class
                data = TextCorpus(data.base.withColumn(
                    "class_id", F.when(self.split().train(), F.col("class_id"))))
            if with_benchmark:
                extra.append(self.benchmark())
            return nb_fit(data, self.classes(label), extra)
        return self._memo(("nb", label, part, with_benchmark), fit)

    def features(self, part: str, normalize: bool, label: str = LR_LABEL) -> lr.FeatureSplit:
        """Feature split; every non-training split is keyed through the
        training dictionary (the same for both normalisations)."""
        def build():
            if part == "train":
                return lr.build_features(self.train(label), normalize)
            c = self.validation(label) if part == "validation" else self.benchmark()
            return lr.build_features(c, normalize, dictionary=self.features("train", normalize, label))
        return self._memo(("x", part, normalize, label), build)

    def lr_run(self, variant: dict, steps: int, label: str = LR_LABEL, scored: tuple[str, ...] = ()) -> lr.BlockRun | None:
        """A run of ``steps`` gradient steps from zeros, with the ``scored`` splits (plain
        counts) in its blocks; None where runs cannot work on blocks."""
        def run():
            feats, k = self.features("train", variant["normalize"], label), self.classes(label).k
            if not feats.in_blocks(k):
                return None
            others = tuple(self.scored_features(part, variant["normalize"], label) for part in scored)
            return lr.run_steps(feats, k, steps, variant["eta"], variant["lam"], others)
        return self._memo(("run", tuple(sorted(variant.items())), steps, label, scored), run)

    def scored_features(self, part: str, normalize: bool, label: str = LR_LABEL) -> lr.FeatureSplit:
        """Plain counts of a split, keyed by the dictionary of a training split."""
        if not normalize:
            return self.features(part, False, label)
        c = self.validation(label) if part == "validation" else self.benchmark()
        return self._memo(("raw", part, label), lambda: lr.build_features(c, False, dictionary=self.features("train", True, label)))

    def lr_weights(self, variant: dict, steps: int, label: str = LR_LABEL) -> DataFrame:
        """W after ``steps`` gradient steps from zeros, a written table."""
        def run():
            feats, k = self.features("train", variant["normalize"], label), self.classes(label).k
            done = self.lr_run(variant, steps, label)
            if done is not None:
                return done.kept()
            if steps == 0:
                return lr.init_weights(feats, k)
            prev = self.lr_weights(variant, steps - 1, label)
            return lr.gradient_step(prev, feats, k, variant["eta"], variant["lam"])
        return self._memo(("W", tuple(sorted(variant.items())), steps, label), run)

    def lr_probabilities(self, variant: dict, steps: int, part: str, label: str = LR_LABEL) -> DataFrame:
        """(doc_id, class_id, p_1..p_k) of a split after ``steps`` steps, from plain counts
        (a training split from what it trains on)."""
        scored = () if part == "train" else (part,)
        done = self.lr_run(variant, steps, label, scored)
        split = self.features("train", variant["normalize"], label) if part == "train" \
            else self.scored_features(part, variant["normalize"], label)
        if done is not None:
            return self._memo(("P", tuple(sorted(variant.items())), steps, part, label), lambda: done.kept_probabilities(split))
        return lr.probabilities(self.lr_weights(variant, steps, label), split, self.classes(label).k, w_rows=split.n_terms)

    @property
    def k_lr(self) -> int:
        return self.classes(LR_LABEL).k
