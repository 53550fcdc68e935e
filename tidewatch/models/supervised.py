"""Supervised classifiers on features or sequences: D11, D12, D13, A11, K2, and tuning, D14."""

from __future__ import annotations

import itertools
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scores import as_flag
from tidewatch.models.base import FittedModel, checked_features, standardised
from tidewatch.models.forest import grow_forest, with_contamination
from tidewatch.models.oneclass import fit_one_class
from tidewatch.models.reconstruction import SequenceModel, sequence_settings
from tidewatch.operators.detect import label_balance
from tidewatch.operators.evaluate import confusion_counts, with_rates
from tidewatch.plans.series import Series
from tidewatch.session import pinned

LOADERS = {
    "random_forest": RandomForestClassificationModel,
    "gradient_boosting": GBTClassificationModel,
    "sequence_classifier": MultilayerPerceptronClassificationModel,
}
# Trees grow until their leaves are pure, or to the deepest that a distributed forest supports.
FOREST_DEPTH = 30
# Components that stand for a sequence in the sequence classifier.
INNER = 64
# Bytes of training rows that a task of the sequence classifier reads in each round.
TRAINING_BYTES = 32 << 20
# The grids searched per kind of model; that of the one-class machine leaves out its kernels, as there is one.
GRIDS = {
    "random_forest": {"numTrees": [50, 100, 200], "maxDepth": [10, 15, 20], "minInstancesPerNode": [1, 3, 5]},
    "gradient_boosting": {"maxIter": [50, 100, 200], "stepSize": [0.01, 0.1, 0.2], "maxDepth": [3, 5, 7]},
    "isolation_forest": {"trees": [50, 100, 200], "sample": [128, 256, 512], "contamination": [0.01, 0.05, 0.1]},
    "one_class_svm": {"nu": [0.01, 0.05, 0.1], "gamma": ["scale", 0.1, 1.0]},
}


class Classifier(FittedModel):
    """prob_<name> and a prediction at one half."""

    def __init__(self, name, features, scaler=None, threshold=0.5, settings=None, algorithm="random_forest"):
        super().__init__(name, features, scaler, threshold, settings or {})
        self.algorithm = algorithm
        self.fitted = None

    def _probability(self, df: DataFrame, vector: Column) -> DataFrame:
        out = self.fitted.transform(df.withColumn("_x", vector))
        p = vector_to_array("_probability").getItem(1)
        flag = as_flag(p > F.lit(self.threshold))
        return out.withColumns({f"prob_{self.name}": p, f"pred_{self.name}": flag}).drop(
            "_x", "_raw", "_probability", "_prediction"
        )

    def scored(self, df: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
        return self._probability(df, self.vector(df))

    def transform(self, df: DataFrame, keys: tuple[str, ...] | None = None, threshold: float | None = None) -> DataFrame:
        return self.scored(df, keys)

    def write_payload(self, path: str, spark) -> None:
        self.fitted.write().overwrite().save(f"{path}/classifier")

    def read_payload(self, path: str, spark) -> None:
        self.fitted = LOADERS[self.algorithm].load(f"{path}/classifier")

    def importance(self, spark) -> DataFrame:
        """(feature, importance), one row per feature."""
        pairs = [(f, float(v)) for f, v in zip(self.features, self.fitted.featureImportances.toArray())]
        return spark.createDataFrame(pairs, "feature string, importance double")


class SequenceClassifier(SequenceModel, Classifier):
    """Classifies whole sequences by a feed-forward network on their leading components."""

    def vectors(self, series: Series, keep: list[str]) -> DataFrame:
        """`keep` and `_v`, the components of every full sequence."""
        components = self.components

        def projected(vectors: np.ndarray) -> pa.Array:
            cells = vectors @ components
            offsets = np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells.ravel()))

        out = self.on_windows(series, keep, projected, "_v", "array<double>")
        return out.withColumn("_v", array_to_vector("_v"))

    def scored_series(self, series: Series) -> DataFrame:
        out = self._probability(self.vectors(series, series.identity), F.col("_v"))
        return out.select(*series.identity, f"prob_{self.name}", f"pred_{self.name}")

    def write_payload(self, path: str, spark) -> None:
        SequenceModel.write_payload(self, path, spark)
        Classifier.write_payload(self, path, spark)

    def read_payload(self, path: str, spark) -> None:
        SequenceModel.read_payload(self, path, spark)
        Classifier.read_payload(self, path, spark)


def class_weights(df: DataFrame, label: str, balanced: bool) -> Column:
    """Weight of a row by its class: n / (2 n_class), or n0 / n1 for positives only.

    Refuses labels of a single class: there is nothing to learn and the weights would be undefined.
    """
    row = label_balance(df, label).first()
    n1, n0 = row["anomalies"], row["normal"]
    if not n1 or not n0:
        raise ValueError(f"Labels need both classes: {n1} anomalous and {n0} normal rows")
    one = (n0 + n1) / (2.0 * n1) if balanced else n0 / n1
    zero = (n0 + n1) / (2.0 * n0) if balanced else 1.0
    return F.when(F.col(label).cast("int") == 1, F.lit(one)).otherwise(F.lit(zero))


_NAMES = {
    "featuresCol": "_x", "labelCol": "_label", "predictionCol": "_prediction",
    "probabilityCol": "_probability", "rawPredictionCol": "_raw",
}


def _training(model: FittedModel, df: DataFrame, label: str, balanced: bool) -> DataFrame:
    weight = class_weights(df, label, balanced)
    return df.select(
        model.vector(df).alias("_x"), F.col(label).cast("double").alias("_label"), weight.alias("_weight")
    )


def _forest(trees: int = 100, depth: int = FOREST_DEPTH, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol="_weight", **_NAMES)


def _boosting(rounds: int = 100, rate: float = 0.1, depth: int = 3, seed: int = 42) -> GBTClassifier:
    boosting = GBTClassifier(
        featuresCol="_x", labelCol="_label", predictionCol="_prediction", weightCol="_weight",
        maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed,
    )
    return boosting.setProbabilityCol("_probability").setRawPredictionCol("_raw")


def fit_random_forest(
    df: DataFrame,
    features: Iterable[str],
    label: str = "label",
    trees: int = 100,
    depth: int = FOREST_DEPTH,
    seed: int = 42,
    name: str = "random_forest",
) -> Classifier:
    """Scaled features, classes weighted to balance."""
    cols = checked_features(df, features)
    model = Classifier(name, cols, standardised(df, cols), settings={"trees": trees, "depth": depth})
    model.fitted = _forest(trees, depth, seed).fit(_training(model, df, label, True))
    return model


def fit_gradient_boosting(
    df: DataFrame,
    features: Iterable[str],
    label: str = "label",
    rounds: int = 100,
    rate: float = 0.1,
    depth: int = 3,
    seed: int = 42,
    name: str = "xgboost",
) -> Classifier:
    """Positives weighted by normal / anomalous."""
    cols = checked_features(df, features)
    model = Classifier(
        name, cols, standardised(df, cols), settings={"trees": rounds}, algorithm="gradient_boosting"
    )
    model.fitted = _boosting(rounds, rate, depth, seed).fit(_training(model, df, label, False))
    return model


Classifier.size_name = "trees"


def fit_sequence_classifier(
    series: Series,
    features: Iterable[str] | None = None,
    label: str = "label",
    length: int = 60,
    hidden: int = 64,
    rounds: int = 100,
    seed: int = 42,
    name: str = "lstm_supervised",
) -> SequenceClassifier:
    """A feed-forward network on the leading components of the sequences, as many as INNER; the label is that of the
    sequence's last row. Training keeps those, not the sequences."""
    cols = series.columns(features)
    model = SequenceClassifier(name, cols, standardised(series.df, cols), algorithm="sequence_classifier")
    model.settings = {**sequence_settings(series, length), "hidden": hidden}
    inner = model.fit_components(series, INNER)
    model.settings["components"] = inner
    rows = model.vectors(series, [label]).select(F.col("_v").alias("_x"), F.col(label).cast("double").alias("_label"))
    # Sequences come out of blocks of up to `block_rows` rows, several to a task; every round reads them, so they are dealt evenly.
    parts = -(-series.profile().rows * 8 * (inner + 3) // TRAINING_BYTES)
    rows = rows.repartition(max(parts, series.df.sparkSession.sparkContext.defaultParallelism))
    network = MultilayerPerceptronClassifier(layers=[inner, hidden, 2], maxIter=rounds, seed=seed, **_NAMES)
    model.fitted = network.fit(pinned(rows))
    return model


def tune(
    kind: str,
    df: DataFrame,
    features: Iterable[str],
    label: str = "label",
    key: Column | None = None,
    grid: dict[str, list] | None = None,
    folds: int = 5,
    parallelism: int = 4,
    seed: int = 42,
) -> tuple[FittedModel, dict]:
    """Best model of a grid and its parameters, by F1 of the anomalous class.

    Supervised kinds are cross-validated. Unsupervised ones never see labels, so each setting is fitted once
    and its flags are scored against them. Settings that differ in the contamination only share one forest, which scores
    the rows once.
    """
    if kind not in GRIDS:
        raise ValueError(f"No parameter grid for {kind!r}; choose from {list(GRIDS)}")
    cols, grid = checked_features(df, features), grid or GRIDS[kind]
    if kind in ("random_forest", "gradient_boosting"):
        model = Classifier(f"{kind}_tuned", cols, standardised(df, cols), algorithm=kind)
        base = _forest(seed=seed) if kind == "random_forest" else _boosting(seed=seed)
        builder = ParamGridBuilder()
        for p, values in grid.items():
            builder = builder.addGrid(base.getParam(p), values)
        judge = MulticlassClassificationEvaluator(
            labelCol="_label", predictionCol="_prediction", metricName="fMeasureByLabel", metricLabel=1.0
        )
        search = CrossValidator(
            estimator=base, estimatorParamMaps=builder.build(), evaluator=judge,
            numFolds=folds, parallelism=parallelism, seed=seed,
        )
        found = search.fit(_training(model, df, label, kind == "random_forest"))
        model.fitted = found.bestModel
        best = {p: model.fitted.getOrDefault(model.fitted.getParam(p)) for p in grid}
        model.settings = {"trees": best.get("numTrees", best.get("maxIter")), **best}
        return model, best
    if kind == "isolation_forest" and key is None:
        raise ValueError("An isolation forest draws rows by their key; give `key`")
    best_model, best, best_f1, forests = None, {}, -1.0, {}
    for values in itertools.product(*grid.values()):
        chosen = dict(zip(grid, values))
        name = f"{kind}_tuned"
        if kind == "isolation_forest":
            drawn = {p: v for p, v in chosen.items() if p != "contamination"}
            if (own := tuple(drawn.items())) not in forests:
                forest = grow_forest(df, cols, key, seed=seed, name=name, **drawn)
                forests[own] = forest, pinned(forest.scored(df).select(label, f"score_{name}"))
            forest, scores = forests[own]
            rest = {p: v for p, v in chosen.items() if p == "contamination"}
            model = with_contamination(forest, scores, **rest)
            flags = model.flagged(scores)
        else:
            model = fit_one_class(df, cols, seed=seed, name=name, **chosen)
            flags = model.transform(df)
        rates = with_rates(confusion_counts(flags, f"pred_{name}", label)).first()
        if rates["f1"] > best_f1:
            best_model, best, best_f1 = model, chosen, rates["f1"]
    return best_model, best
