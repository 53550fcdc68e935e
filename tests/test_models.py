import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import collected, frame, series
from tidewatch.models.forest import expected_depth, fit_isolation_forest
from tidewatch.models.oneclass import fit_one_class
from tidewatch.models.reconstruction import fit_reconstruction, fit_sequence_reconstruction, training_threshold
from tidewatch.models.store import load_models, predict, registry, save_models
from tidewatch.models.supervised import fit_gradient_boosting, fit_random_forest, fit_sequence_classifier, tune
from tidewatch.operators.evaluate import confusion_counts, with_rates
from tidewatch.plans.lagged import lag_products
from tidewatch.session import scratch_path

NAMES = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def cloud(spark):
    """Normal rows near a plane, and a few far from it."""
    rng = np.random.default_rng(0)
    base = rng.normal(size=(600, 3))
    x = np.hstack([base, base @ rng.normal(size=(3, 3)) + 0.05 * rng.normal(size=(600, 3))])
    label = np.zeros(600, int)
    label[:30] = 1
    x[:30] = rng.normal(size=(30, 6)) * 10
    pdf = pd.DataFrame(x, columns=NAMES).assign(id=[f"r{i}" for i in range(600)], label=label)
    return spark.createDataFrame(pdf).cache()


def f1(df, name):
    return with_rates(confusion_counts(df, f"pred_{name}", "label")).first()["f1"]


def test_path_normaliser():
    assert expected_depth(1) == 0 and expected_depth(2) == 1
    assert float(expected_depth(256)) == pytest.approx(10.244, abs=1e-3)


def test_isolation_forest_separates_and_does_not_depend_on_partitions(cloud):
    model = fit_isolation_forest(cloud, NAMES, F.col("id"), trees=40, sample=64)
    out = model.transform(cloud)
    assert f1(out, "isolation_forest") > 0.8
    assert out.agg(F.avg("pred_isolation_forest")).first()[0] == pytest.approx(0.05, abs=0.005)
    again = fit_isolation_forest(cloud.repartition(11), NAMES, F.col("id"), trees=40, sample=64)
    assert again.threshold == pytest.approx(model.threshold, abs=1e-12)


def test_one_class_flags_the_asked_share(cloud):
    model = fit_one_class(cloud, NAMES, nu=0.1, size=64, steps=3)
    out = model.transform(cloud)
    assert out.agg(F.avg("pred_one_class_svm")).first()[0] == pytest.approx(0.1, abs=0.01)
    assert out.filter("label = 1").agg(F.avg("pred_one_class_svm")).first()[0] > 0.8


def test_reconstruction(cloud):
    normal = cloud.filter("label = 0")
    model = fit_reconstruction(normal, NAMES)
    assert f1(model.transform(cloud), "autoencoder") > 0.6
    x = np.array(normal.select(*NAMES).collect())
    z = (x - x.mean(0)) / x.std(0)
    _, _, vt = np.linalg.svd(z, full_matrices=False)
    lost = ((z - z @ vt[:3].T @ vt[:3]) ** 2).mean(1)
    got = sorted(r[0] for r in model.scored(normal).select("score_autoencoder").collect())
    np.testing.assert_allclose(got, np.sort(lost), atol=1e-8)
    assert model.threshold == pytest.approx(lost.mean() + 2 * lost.std())
    with pytest.raises(ValueError):
        training_threshold(normal, "f0", "guess")


def test_supervised_store_and_registry(spark, cloud):
    models = {
        "random_forest": fit_random_forest(cloud, NAMES, trees=20, depth=6),
        "xgboost": fit_gradient_boosting(cloud, NAMES, rounds=5),
        "autoencoder": fit_reconstruction(cloud, NAMES),
        "isolation_forest": fit_isolation_forest(cloud, NAMES, F.col("id"), trees=10, sample=64),
        "one_class_svm": fit_one_class(cloud, NAMES, size=32, steps=1),
    }
    before = predict(models, cloud)
    assert f1(before, "random_forest") > 0.8 and f1(before, "xgboost") > 0.8
    path = scratch_path(spark, "models")
    save_models(spark, models, path)
    loaded = load_models(spark, path)
    assert set(loaded) == set(models)
    cells = [c for c in before.columns if c.startswith(("pred_", "score_", "prob_"))]
    a = np.array(before.orderBy("id").select(*cells).collect(), dtype=float)
    b = np.array(predict(loaded, cloud).orderBy("id").select(*cells).collect(), dtype=float)
    np.testing.assert_allclose(a, b)
    table = {r["name"]: r for r in registry(spark, models).collect()}
    assert table["random_forest"]["size"] == 20 and table["xgboost"]["algorithm"] == "gradient_boosting"
    assert table["autoencoder"]["has_scaler"]
    importance = models["random_forest"].importance(spark).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)
    # Columns the models know but the frame lacks count as 0; extra ones do not matter.
    assert predict(models, cloud.drop("f5").withColumn("more", F.lit(1)), ["autoencoder"]).count() == 600
    with pytest.raises(ValueError, match="nothere"):
        predict(models, cloud, ["nothere"])
    with pytest.raises(ValueError):
        predict({}, cloud)


def test_one_class_of_labels_is_refused(cloud):
    with pytest.raises(ValueError, match="both classes"):
        fit_random_forest(cloud.filter("label = 0"), NAMES)


def test_sequence_models_leave_rows_without_a_sequence_open(spark):
    pdf = frame(80)
    s = series(spark, pdf)
    s = s.with_df(s.df.withColumn("label", (F.col("x") > 11).cast("int")))
    model = fit_sequence_reconstruction(s, ["x", "y"], length=10)
    out = model.transform(s.df)
    assert out.count() == 160 and out.filter("score_lstm_autoencoder IS NULL").count() == 18
    assert out.filter("score_lstm_autoencoder IS NULL AND pred_lstm_autoencoder IS NOT NULL").count() == 0
    classifier = fit_sequence_classifier(s, ["x", "y"], length=5, hidden=8, rounds=60)
    out = classifier.transform(s.df)
    assert out.count() == 160 and out.filter("prob_lstm_supervised IS NULL").count() == 8
    assert f1(out, "lstm_supervised") > 0.8


@pytest.mark.parametrize("block", [25, 1_000_000])
def test_sequence_errors_equal_those_of_stored_sequences(spark, block):
    """Against numpy on all sequences written out, for series in blocks too."""
    pdf, length = frame(90), 12
    s = series(spark, pdf, block)
    model = fit_sequence_reconstruction(s, ["x", "y"], length=length)
    scale = [model.scaler.parameters[c] for c in ("x", "y")]
    rows, names = [], []
    for _, own in pdf.sort_values(["key", "ts", "id"]).groupby("key"):
        x = np.column_stack([(own[c] - m) / d for c, (m, d) in zip(("x", "y"), scale)])
        rows += [x[i : i + length].ravel() for i in range(len(x) - length + 1)]
        names += list(zip(own["key"], own["id"]))[length - 1 :]
    rows = np.array(rows)
    spread = np.cov(rows.T)
    values, vectors = np.linalg.eigh(spread)
    top = vectors[:, ::-1][:, : model.settings["components"]]
    want = dict(zip(names, ((rows**2).sum(axis=1) - ((rows @ top) ** 2).sum(axis=1)) / rows.shape[1]))
    got = {(r["key"], r["id"]): r["score_lstm_autoencoder"] for r in model.scored_series(s).collect()}
    assert got.keys() == want.keys()
    np.testing.assert_allclose([got[k] for k in want], list(want.values()), rtol=1e-8, atol=1e-10)
    with pytest.raises(ValueError, match="sequence"):
        fit_sequence_reconstruction(series(spark, frame(5)), ["x"], length=6)


def test_sequence_models_are_saved_with_their_components(spark, tmp_path):
    s = series(spark, frame(60))
    s = s.with_df(s.df.withColumn("label", (F.col("x") > 11).cast("int")))
    models = {
        "lstm_autoencoder": fit_sequence_reconstruction(s, ["x"], length=6),
        "lstm_supervised": fit_sequence_classifier(s, ["x"], length=4, hidden=4, rounds=20),
    }
    save_models(spark, models, str(tmp_path / "models"))
    again = load_models(spark, str(tmp_path / "models"))
    for name, cell in (("lstm_autoencoder", "score_lstm_autoencoder"), ("lstm_supervised", "prob_lstm_supervised")):
        a, b = (collected(m[name].transform(s.df))[cell].to_numpy() for m in (models, again))
        np.testing.assert_allclose(a, b)


def test_lag_products_equal_written_out_windows():
    rng = np.random.default_rng(2)
    for n, length, d in ((30, 5, 2), (6, 5, 1), (40, 7, 3)):
        x = rng.normal(size=(n, d))
        for first in {length - 1, n - 1}:
            sums, products = lag_products(x, first, length)
            rows = np.array([np.concatenate([x[t - a] for a in range(length)]) for t in range(first, n)])
            np.testing.assert_allclose(sums, rows.sum(axis=0), atol=1e-12)
            np.testing.assert_allclose(products, rows.T @ rows, atol=1e-12)


def test_tuning(cloud):
    model, best = tune("random_forest", cloud, NAMES, grid={"maxDepth": [1, 5], "numTrees": [10]}, folds=2)
    assert best == {"maxDepth": 5, "numTrees": 10} and f1(model.transform(cloud), "random_forest_tuned") > 0.7
    with pytest.raises(ValueError):
        tune("nearest_neighbours", cloud, NAMES)
    with pytest.raises(ValueError, match="key"):
        tune("isolation_forest", cloud, NAMES)


def test_settings_that_differ_in_contamination_share_one_forest(spark, monkeypatch):
    from tidewatch.models import forest, supervised

    rows = spark.range(400).select("id", *[F.rand(i).alias(n) for i, n in enumerate(NAMES)], (F.col("id") % 10 == 0).cast("int").alias("label"))
    grown = []
    monkeypatch.setattr(supervised, "grow_forest", lambda *a, **b: grown.append(b) or forest.grow_forest(*a, **b))
    key = F.col("id").cast("string")
    model, best = tune("isolation_forest", rows, NAMES, key=key, grid={"trees": [5], "sample": [32], "contamination": [0.05, 0.2]})
    want = fit_isolation_forest(rows, NAMES, key, name="isolation_forest_tuned", **best)
    assert len(grown) == 1 and model.threshold == want.threshold and model.settings == want.settings


def test_training_rows_of_sequences_are_dealt_evenly(spark, monkeypatch):
    from tidewatch.models import supervised
    from tidewatch import load_series

    seen = []

    def stored(rows):
        seen.append([len(p) for p in rows.rdd.glom().collect()])
        return rows

    monkeypatch.setattr(supervised, "pinned", stored)
    rows = spark.range(3000).select(F.lit("a").alias("k"), "id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    series = load_series(rows, ["k"], "id", None, ["x"])
    supervised.fit_sequence_classifier(series, ["x"], length=4, hidden=2, rounds=1)
    assert sum(seen[0]) == 2997 and max(seen[0]) < 1000
