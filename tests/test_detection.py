import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import close, collected, frame, series
from tidewatch.operators import detect, ensemble, evaluate
from tidewatch.operators.inject import Drift, Intermittent, Spike, apply_plan, inject, random_plan, read_plan


def by_key(pdf, rule):
    ordered = pdf.sort_values(["key", "ts", "id"])
    flags = pd.concat([rule(g["x"]) for _, g in ordered.groupby("key")])
    return ordered.assign(f=flags).sort_values(["key", "id"])["f"].tolist()


def robust(x, w=20, t=3.0):
    off = x - x.rolling(w).median()
    mad = off.abs().rolling(w).median() + 1e-9
    return (0.6745 * off / mad).fillna(0).abs() > t


@pytest.mark.parametrize("block", [45, 1_000_000])
def test_detectors_equal_pandas(spark, block):
    pdf = frame(150, gaps=0.02)
    s = series(spark, pdf, block)
    got = collected(detect.threshold_detector(s, "x", k=1.5))["anomaly"].tolist()
    assert got == by_key(pdf, lambda x: (x > x.mean() + 1.5 * x.std()) | (x < x.mean() - 1.5 * x.std()))
    got = collected(detect.moving_average_detector(s, "x", 20, 1.5))["anomaly"].tolist()
    assert got == by_key(pdf, lambda x: (x - x.rolling(20).mean()).abs() > 1.5 * x.rolling(20).std())
    got = collected(detect.robust_z_detector(s, "x", 20, 2.0))["anomaly"].tolist()
    assert got == by_key(pdf, lambda x: robust(x, 20, 2.0))


def test_label_balance_without_anomalies(spark):
    row = detect.label_balance(spark.createDataFrame([(0,), (0,)], "label int")).first()
    assert (row["anomalies"], row["normal"], row["positive_weight"]) == (0, 2, None)


def test_injection(spark):
    pdf = frame(200, ["a"])
    s = series(spark, pdf)
    ordered = pdf.sort_values(["ts", "id"]).reset_index(drop=True)
    x, sd = ordered["x"].to_numpy(), ordered["x"].std(ddof=0)
    got = inject(s, [Spike("x", 0.5, 0.1, 4.0)]).orderBy("ts", "id").toPandas()
    want, truth = x.copy(), np.zeros(200, bool)
    for i in range(90, 110):
        want[i] += 4 * (1 - (abs(i - 100) / 10) ** 2) * sd
        truth[i] = True
    close(got["x"], want)
    assert got["x_anomaly"].tolist() == truth.tolist()
    got = inject(s, [Drift("x", 0.25, 0.75, 2.0)]).orderBy("ts", "id").toPandas()
    want = x.copy()
    want[50:150] += np.arange(100) / 100 * 2 * sd
    close(got["x"], want)
    with pytest.raises(ValueError):
        Drift("x", 0.7, 0.7)
    one_row = inject(s, [Spike("x", 0.5, 0.001)])
    assert one_row.filter("x_anomaly").count() == 0


def test_second_anomaly_scales_with_what_the_first_left(spark):
    pdf = frame(100, ["a"])
    got = inject(series(spark, pdf), [Drift("x", 0.0, 0.5, 3.0), Drift("x", 0.5, 1.0, 1.0)])
    x = pdf.sort_values(["ts", "id"])["x"].to_numpy().copy()
    x[:50] += np.arange(50) / 50 * 3 * x.std()
    x[50:] += np.arange(50) / 50 * 1 * x.std()
    close(got.orderBy("ts", "id").toPandas()["x"], x)


def test_intermittent_share_and_stability(spark):
    s = series(spark, frame(1000, ["a"]))
    plan = [Intermittent("x", 0.2, 0.8, 0.3, 2.0)]
    a = collected(inject(s, plan))
    b = collected(inject(s.with_df(s.df.repartition(7)), plan))
    assert a.equals(b)
    assert 0.25 < a["x_anomaly"].sum() / 600 < 0.35


def test_plans(spark):
    text = json.dumps({"anomalies": [{"type": "spike", "sensor": "x"}, {"type": "drift", "sensor": "y"}]})
    assert read_plan(text) == [Spike("x"), Drift("y")]
    assert {"x_anomaly", "y_anomaly"} <= set(apply_plan(series(spark, frame(50)), text).columns)
    with pytest.raises(ValueError):
        read_plan('{"anomalies": [{"type": "melt", "sensor": "x"}]}')
    assert random_plan(["x", "y"], 4, 1) == random_plan(["x", "y"], 4, 1)
    assert len(random_plan(["x", "y"], 4, 2)) == 8


def scored(spark, n=300, places=2, seed=0):
    rng = np.random.default_rng(seed)
    truth = rng.random(n) < 0.3
    score = np.round(rng.normal(size=n) + truth, places)
    pdf = pd.DataFrame({"s": score, "t": truth.astype(int), "p": (score > 0.5).astype(int)})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("block", [25, 1_000_000])
def test_curves(spark, block):
    pdf, df = scored(spark)
    pos, neg = pdf["t"].sum(), (1 - pdf["t"]).sum()
    for r in evaluate.roc_curve(df, "s", "t", block_rows=block).collect()[:40]:
        above = pdf["s"] >= r["threshold"]
        assert r["tpr"] == pytest.approx((above & (pdf["t"] == 1)).sum() / pos)
        assert r["fpr"] == pytest.approx((above & (pdf["t"] == 0)).sum() / neg)
    a, b = pdf[pdf["t"] == 1]["s"].to_numpy()[:, None], pdf[pdf["t"] == 0]["s"].to_numpy()[None, :]
    want = ((a > b) + 0.5 * (a == b)).mean()
    assert evaluate.roc_auc(df, "s", "t", block_rows=block).first()[0] == pytest.approx(want)


def test_sweep(spark):
    pdf, df = scored(spark, places=1)
    x = (pdf["s"] - pdf["s"].min()) / (pdf["s"].max() - pdf["s"].min())
    rows = evaluate.f1_sweep(df, "s", "t").orderBy("threshold").collect()
    assert len(rows) == 100
    for r in rows:
        p = x > r["threshold"]
        tp = (p & (pdf["t"] == 1)).sum()
        want = 2 * tp / (p.sum() + pdf["t"].sum()) if tp else 0
        assert r["f1"] == pytest.approx(want)
    best = evaluate.optimal_threshold(spark.createDataFrame(rows)).first()
    assert best["optimal_f1"] == max(r["f1"] for r in rows)


def test_rates_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "p int, t int")
    row = evaluate.with_rates(evaluate.confusion_counts(df, "p", "t")).first()
    assert (row["tn"], row["precision"], row["recall"], row["f1"]) == (2, 0.0, 0.0, 0.0)


def test_best_detector_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([("a", "s", 0.5, 0), ("b", "s", 0.5, 1)], "detector string, sensor string, f1 double, listing int")
    assert evaluate.best_detector(df).first()["best_detector"] == "a"


def test_ensembles(spark):
    df = spark.createDataFrame(
        [(1, 0, 1), (1, 0, 0), (0, None, 1), (1, None, 0)], "pred_a int, pred_lstm int, pred_random_forest int"
    )
    got = [r["ensemble"] for r in ensemble.combine(df, "majority_vote").collect()]
    assert got == [1, 0, 0, 0]
    got = [r["ensemble"] for r in ensemble.combine(df, "weighted_vote").collect()]
    assert got == [1, 0, 1, 0]
    assert [r["ensemble"] for r in ensemble.combine(df, "max_probability").collect()] == [1, 1, 1, 1]
    assert [r["ensemble"] for r in ensemble.combine(df, "confidence_weighted").collect()] == [1, 0, 0, 0]
    with pytest.raises(ValueError):
        ensemble.combine(df, "coin")
    with pytest.raises(ValueError):
        ensemble.combine(df.select(F.lit(1).alias("x")))


def test_confidence_and_flat_scores(spark):
    df = spark.createDataFrame([(1, 5.0), (0, 5.0)], "pred_a int, score_a double")
    out = ensemble.with_confidence(df, {"a": 5.0})
    assert {r["conf_a"] for r in out.collect()} == {0.5}
    assert [r["ensemble"] for r in ensemble.combine(df, "max_probability").collect()] == [0, 0]
    far = ensemble.with_confidence(spark.createDataFrame([(1, 1e12)], "pred_a int, score_a double"), {"a": 1e-6})
    assert far.first()["conf_a"] == 1.0


def test_raised_thresholds(spark):
    table = ensemble.threshold_table(spark, {"a": 2.0})
    assert ensemble.read_thresholds(ensemble.raised_thresholds(table, F.lit(0.5))) == {"a": pytest.approx(2.2)}
    assert ensemble.read_thresholds(ensemble.raised_thresholds(table, F.lit(0.3))) == {"a": 2.0}
