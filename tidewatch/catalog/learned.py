"""Queries for learned detectors, and for the rules around them that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.catalog.fixtures import LONG_SQL, long_series, table
from tidewatch.catalog.messaging import stream_series
from tidewatch.catalog.registry import query, r, rounded
from tidewatch.functions.hashing import row_key
from tidewatch.models.forest import fit_isolation_forest
from tidewatch.models.oneclass import fit_one_class
from tidewatch.models.reconstruction import (
    fit_reconstruction,
    fit_sequence_reconstruction,
    training_threshold,
)
from tidewatch.models.store import load_models, predict_with_confidence, registry, save_models
from tidewatch.models.supervised import (
    fit_gradient_boosting,
    fit_random_forest,
    fit_sequence_classifier,
    tune,
)
from tidewatch.operators import ensemble, evaluate
from tidewatch.operators.inject import Drift, Spike, inject
from tidewatch.operators.missing import fill_zero
from tidewatch.plans.profiles import row_features, stream_features
from tidewatch.plans.series import Series
from tidewatch.session import pinned, scratch_path
from tidewatch.sources.files import write_report
from tidewatch.streaming.scoring import StreamScorer, start_scoring
from tidewatch.streaming.windows import count_windows, stream_count_windows, window_rows

FEATURES = ["value", "value_roll_mean_10", "value_roll_std_10", "value_roll_max_10", "value_diff_1"]
DIMENSIONS = 64


def labelled(spark, sf: str) -> tuple[DataFrame, Series]:
    """Events with an injected spike and drift, row features and the known truth as label."""
    s = long_series(spark, sf)
    spiked = inject(s, [Spike("value", 0.3, 0.04, 6.0), Drift("value", 0.6, 0.7, 5.0)])
    spiked = spiked.withColumn("label", F.col("value_anomaly").cast("int")).drop("value_anomaly")
    series = s.with_df(spiked)
    out = row_features(series, ["value"], [10], ["mean", "std", "max"], [1], ["diff"])
    # Training passes over its input many times.
    out = pinned(fill_zero(out, FEATURES))
    return out, series.with_df(out)


def key_of(series: Series):
    return row_key(*series.keys, series.tie)


def embedded(spark, sf: str) -> tuple[DataFrame, list[str]]:
    names = [f"e{i}" for i in range(DIMENSIONS)]
    cells = [F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]
    return table(spark, sf, "embeddings").select("vec_id", *cells), names


@query("isolation_forest")
def isolation(spark, sf):
    rows, s = labelled(spark, sf)
    model = fit_isolation_forest(rows, FEATURES, key_of(s))
    return model.transform(rows).select("event_id", "label", "pred_isolation_forest", "score_isolation_forest")


@query("rff_one_class")
def one_class(spark, sf):
    rows, _ = labelled(spark, sf)
    model = fit_one_class(rows, FEATURES)
    return model.transform(rows).select("event_id", "label", "pred_one_class_svm", "score_one_class_svm")


@query("reconstruction_detector")
def reconstruction(spark, sf):
    rows, names = embedded(spark, sf)
    out = fit_reconstruction(rows, names).transform(rows)
    return out.select("vec_id", "pred_autoencoder", "score_autoencoder")


@query("reconstruction_p95")
def reconstruction_p95(spark, sf):
    rows, names = embedded(spark, sf)
    out = fit_reconstruction(rows, names, rule="p95").transform(rows)
    return out.select("vec_id", "pred_autoencoder", "score_autoencoder")


@query(
    "reconstruction_thresholds",
    f"SELECT {r('avg(value) + 2 * stddev_pop(value)', 'deviations')}, {r('quantile_cont(value, 0.95)', 'p95')} FROM events",
)
def rules(spark, sf):
    errors = table(spark, sf, "events").select("value")
    cells = [F.lit(training_threshold(errors, "value", rule)).alias(rule) for rule in ("deviations", "p95")]
    return rounded(errors.agg(F.count(F.lit(1)).alias("n")).select(*cells), [])


# Every series of n readings has n - 59 sequences of 60; each has an error, and a flag that says whether it is over the cut.
_SEQUENCE_SQL = f"""SELECT event_type, count(*) AS rows, greatest(count(*) - 59, 0) AS scored, greatest(count(*) - 59, 0) AS consistent
  FROM ({LONG_SQL}) GROUP BY event_type"""


@query("sequence_reconstruction", _SEQUENCE_SQL)
def sequence_reconstruction(spark, sf):
    _, s = labelled(spark, sf)
    model = fit_sequence_reconstruction(s, ["value"])
    score, pred = F.col("score_lstm_autoencoder"), F.col("pred_lstm_autoencoder")
    agrees = (score >= 0) & ((score > model.threshold) == (pred == 1))
    return model.transform(s.df).groupBy("event_type").agg(
        F.count("*").alias("rows"), F.count(score).alias("scored"), F.count_if(agrees).alias("consistent")
    )


@query("random_forest")
def forest(spark, sf):
    rows, s = labelled(spark, sf)
    train, test = evaluate.train_test_split(rows, key_of(s))
    model = fit_random_forest(train, FEATURES, depth=8, trees=50)
    return model.transform(test).select("event_id", "label", "pred_random_forest", "prob_random_forest")


@query("gradient_boosting")
def boosting(spark, sf):
    rows, s = labelled(spark, sf)
    train, test = evaluate.train_test_split(rows, key_of(s))
    model = fit_gradient_boosting(train, FEATURES, rounds=15)
    return model.transform(test).select("event_id", "label", "pred_xgboost", "prob_xgboost")


@query("feature_importance")
def importance(spark, sf):
    rows, _ = labelled(spark, sf)
    return fit_random_forest(rows, FEATURES, depth=6, trees=20).importance(spark)


@query("top_features")
def top(spark, sf):
    rows, _ = labelled(spark, sf)
    return evaluate.top_features(fit_random_forest(rows, FEATURES, depth=6, trees=20).importance(spark), 3)


@query("sequence_classifier", _SEQUENCE_SQL)
def sequence_classifier(spark, sf):
    _, s = labelled(spark, sf)
    model = fit_sequence_classifier(s, ["value", "value_diff_1"], rounds=40)
    prob, pred = F.col("prob_lstm_supervised"), F.col("pred_lstm_supervised")
    agrees = prob.between(0, 1) & ((prob > 0.5) == (pred == 1))
    return model.transform(s.df).groupBy("event_type").agg(
        F.count("*").alias("rows"), F.count(prob).alias("scored"), F.count_if(agrees).alias("consistent")
    )


@query("tuned_random_forest")
def tuned(spark, sf):
    rows, _ = labelled(spark, sf)
    model, _ = tune("random_forest", rows, FEATURES, grid={"maxDepth": [3, 6], "numTrees": [20]}, folds=3)
    return model.transform(rows).select("event_id", "label", "pred_random_forest_tuned")


@query("tuned_isolation_forest")
def tuned_isolation(spark, sf):
    rows, s = labelled(spark, sf)
    grid = {"trees": [50], "sample": [128], "contamination": [0.05, 0.1]}
    model, _ = tune("isolation_forest", rows, FEATURES, key=key_of(s), grid=grid)
    return model.transform(rows).select("event_id", "label", "pred_isolation_forest_tuned")


def _trio(rows: DataFrame, s: Series) -> dict:
    return {
        "isolation_forest": fit_isolation_forest(rows, FEATURES, key_of(s)),
        "autoencoder": fit_reconstruction(rows, FEATURES),
        "random_forest": fit_random_forest(rows, FEATURES, depth=6, trees=20),
    }


@query("predict_with_confidence")
def predictions(spark, sf):
    """Three kinds of models stored, loaded again, and combined."""
    rows, s = labelled(spark, sf)
    path = scratch_path(spark, "models")
    save_models(spark, _trio(rows, s), path)
    out = predict_with_confidence(load_models(spark, path), rows)
    out = ensemble.mean_confidence(ensemble.combine(out, "confidence_weighted"))
    keep = [c for c in out.columns if c.startswith(("pred_", "prob_", "score_", "conf_"))]
    return out.select("event_id", "label", *keep, "ensemble", "confidence")


@query("stream_model_alerts")
def stream_model_alerts(spark, sf):
    """Windows of a stream scored by two stored models, with thresholds kept between micro-batches."""
    s = stream_series(spark, sf)
    table_ = long_series(spark, sf)
    names = ["value", "value_roll_mean_5", "value_roll_std_10", "value_diff_1"]
    # Training reads these columns many times, and no others.
    rows = pinned(stream_features(window_rows(count_windows(table_), table_)).select("event_type", "window", "event_id", *names))
    key = row_key("event_type", "window", "event_id")
    models = {
        "autoencoder": fit_reconstruction(rows, names),
        "isolation_forest": fit_isolation_forest(rows, names, key),
    }
    out = scratch_path(spark, "scored")
    scorer = StreamScorer(s, models, out)
    start_scoring(stream_count_windows(s), scorer, f"{out}-checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{out}/alerts")


@query(
    "stream_sequence_alerts",
    f"""SELECT event_type, (rn - 60) // 10 AS "window", 60 AS rows, 60 AS readings, 41 AS scored, 41 AS same FROM (
      SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM ({LONG_SQL}))
      WHERE rn >= 60 AND (rn - 60) % 10 = 0""",
)
def stream_sequence_alerts(spark, sf):
    """A sequence model on overlapping windows: every window keeps its 60 rows, of which the last 41 end a sequence of 20."""
    s = stream_series(spark, sf)
    model = fit_sequence_reconstruction(long_series(spark, sf), ["value"], length=20)
    out = scratch_path(spark, "sequences")
    scorer = StreamScorer(s, {"lstm_autoencoder": model}, out)
    start_scoring(stream_count_windows(s), scorer, f"{out}-checkpoint", once=True).awaitTermination()
    scored = spark.read.parquet(f"{out}/predictions")
    whole = long_series(spark, sf)
    batch = model.scored_series(whole).select("event_type", "event_id", F.col("score_lstm_autoencoder").alias("whole_score"))
    same = F.abs(F.col("score_lstm_autoencoder") - F.col("whole_score")) < 1e-9
    return scored.join(batch, ["event_type", "event_id"], "left").groupBy("event_type", "window").agg(
        F.count("*").cast("int").alias("rows"),
        F.countDistinct("event_id").cast("int").alias("readings"),
        F.count("score_lstm_autoencoder").cast("int").alias("scored"),
        F.count_if(same).cast("int").alias("same"),
    )


@query("model_registry")
def registered(spark, sf):
    rows, s = labelled(spark, sf)
    return registry(spark, _trio(rows, s))


@query("model_report")
def report(spark, sf):
    """All metrics of a classifier on held-out rows, written and read back."""
    rows, s = labelled(spark, sf)
    train, test = evaluate.train_test_split(rows, key_of(s))
    scored = pinned(fit_random_forest(train, FEATURES, depth=6, trees=20).transform(test))
    metrics = evaluate.evaluate_model(
        scored, "random_forest", "pred_random_forest", "label", probability="prob_random_forest"
    )
    path = scratch_path(spark, "report")
    write_report(metrics, path)
    return spark.read.schema("metric string, at double, value double, model string").json(path)
