import json

import pandas as pd
from pyspark.sql import functions as F

from tests.helpers import SCHEMA, frame
from tidewatch import load_series
from tidewatch.models.reconstruction import fit_reconstruction, fit_sequence_reconstruction
from tidewatch.models.forest import fit_isolation_forest
from tidewatch.operators.ensemble import threshold_table
from tidewatch.plans.profiles import stream_features
from tidewatch.session import scratch_path
from tidewatch.sources import files
from tidewatch.sources.messages import READING, as_messages, kafka_options, records
from tidewatch.streaming import windows
from tidewatch.streaming.progress import PROGRESS_SCHEMA, stage_stats
from tidewatch.streaming.scoring import StreamScorer, start_scoring


def parts(spark, pdf, path, n=4, late=None):
    """n files in order of time, with the rows of each shuffled; `late` rows come in the last file."""
    ordered = pdf.sort_values("ts").reset_index(drop=True)
    cuts = [ordered.iloc[i * len(ordered) // n : (i + 1) * len(ordered) // n] for i in range(n)]
    if late is not None:
        cuts.append(late)
    for cut in cuts:
        df = spark.createDataFrame(cut.sample(frac=1, random_state=1), SCHEMA)
        df.coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, per_trigger=1):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(path)


def finished(spark, df, label):
    out = scratch_path(spark, label)
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c")
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def described(df):
    cells = [F.transform("rows", lambda r: r["id"]).alias("ids"), F.round(F.aggregate("rows.x", F.lit(0.0), lambda a, x: a + x), 6).alias("x")]
    return sorted(tuple(map(str, r)) for r in df.select("key", "window", *cells).collect())


def test_count_windows_over_micro_batches_equal_the_table(spark):
    pdf = frame(130)
    path = scratch_path(spark, "in")
    parts(spark, pdf, path)
    live = load_series(stream(spark, path), ["key"], "ts", "id", ["x", "y"])
    table = load_series(spark.read.schema(SCHEMA).parquet(path), ["key"], "ts", "id", ["x", "y"])
    got = finished(spark, windows.stream_count_windows(live), "windows")
    want = windows.count_windows(table)
    assert described(got) == described(want)
    assert got.count() == 2 * 8
    a = stream_features(windows.window_rows(got, live)).orderBy("key", "window", "id").toPandas()
    b = stream_features(windows.window_rows(want, table)).orderBy("key", "window", "id").toPandas()
    pd.testing.assert_frame_equal(a, b[a.columns])


def test_late_rows_fall_behind_the_watermark(spark):
    pdf = frame(100, ["a"])
    late = pdf.head(1).assign(ts=pdf["ts"].min() - pd.Timedelta(days=3), id=999)
    path = scratch_path(spark, "late")
    parts(spark, pdf, path, 3, late)
    df = windows.time_windows(stream(spark, path), "ts", "1 minute", [F.count("x").alias("n")], ["key"], late="10 seconds")
    got = finished(spark, df, "late-out")
    want = windows.time_windows(spark.createDataFrame(pdf, SCHEMA), "ts", "1 minute", [F.count("x").alias("n")], ["key"])
    end = got.agg(F.max("end")).first()[0]
    assert got.exceptAll(want).count() == 0 and got.count() == want.filter(F.col("end") <= F.lit(end)).count()


def test_duplicates_are_dropped_across_batches(spark):
    pdf = frame(40, ["a"])
    path = scratch_path(spark, "twice")
    parts(spark, pd.concat([pdf, pdf]), path, 4)
    assert finished(spark, windows.deduplicated(stream(spark, path), ["id"], "ts", "1 hour"), "once").count() == 40


def scorer_run(spark, models, folder, path, alerts=None):
    live = load_series(stream(spark, path), ["key"], "ts", "id", ["x", "y"])
    scorer = StreamScorer(live, models, folder, on_alert=alerts)
    start_scoring(windows.stream_count_windows(live), scorer, f"{folder}-c", once=True).awaitTermination()
    return scorer


def test_scoring_warms_up_then_uses_confidence_and_repeats_safely(spark):
    pdf = frame(140)
    path, folder = scratch_path(spark, "in"), scratch_path(spark, "scored")
    parts(spark, pdf, path, 6)
    table = load_series(spark.read.schema(SCHEMA).parquet(path), ["key"], "ts", "id", ["x", "y"])
    rows = stream_features(windows.window_rows(windows.count_windows(table), table))
    names = ["x", "y", "x_roll_mean_5", "y_roll_std_10", "x_diff_1"]
    models = {
        "autoencoder": fit_reconstruction(rows, names),
        "isolation_forest": fit_isolation_forest(rows, names, F.concat_ws(":", "key", "window", "id"), trees=5, sample=32),
    }
    seen = []
    scorer = scorer_run(spark, models, folder, path, lambda df, b: seen.append(b))
    alerts = spark.read.parquet(f"{folder}/alerts")
    methods = {r["batch"]: r["ensemble_method"] for r in alerts.select("batch", "ensemble_method").distinct().collect()}
    assert set(methods) == set(seen)
    assert all(m == ("weighted_vote" if b < 4 else "confidence_weighted") for b, m in methods.items())
    assert "confidence_weighted" in methods.values()
    last = max(seen)
    thresholds = spark.read.parquet(f"{folder}/thresholds/batch={last}").count()
    assert thresholds == 2 and spark.read.parquet(f"{folder}/recent/batch={last}").count() > 100
    before = spark.read.parquet(f"{folder}/alerts/batch={last}").toPandas()
    live = windows.count_windows(table)
    again = live.join(alerts.filter(F.col("batch") == last).select("key", "window").distinct(), ["key", "window"])
    scorer(again, last)
    after = spark.read.parquet(f"{folder}/alerts/batch={last}").toPandas()
    assert len(before) == len(after)
    assert before["is_anomaly"].sum() == after["is_anomaly"].sum()


def test_scoring_without_models_uses_the_fallback_rule(spark):
    pdf = frame(80, ["a"])
    pdf.loc[70, "x"] = 500.0
    path, folder = scratch_path(spark, "in"), scratch_path(spark, "fallback")
    parts(spark, pdf, path, 2)
    scorer_run(spark, {}, folder, path)
    out = spark.read.parquet(f"{folder}/alerts")
    assert out.count() == 3 * 60
    assert {r["sensor_x"] for r in out.filter("is_anomaly").collect()} >= {500.0}


def test_sequence_models_score_windows_as_in_batch(spark):
    pdf = frame(150)
    path, folder = scratch_path(spark, "in"), scratch_path(spark, "sequences")
    parts(spark, pdf, path, 3)
    table = load_series(spark.read.schema(SCHEMA).parquet(path), ["key"], "ts", "id", ["x", "y"])
    model = fit_sequence_reconstruction(table, ["x", "y"], length=12)
    threshold = model.threshold
    scorer_run(spark, {"lstm_autoencoder": model}, folder, path)
    live = spark.read.parquet(f"{folder}/predictions")
    rows = windows.window_rows(windows.count_windows(table), table)
    want = model.transform(stream_features(rows), tuple(rows.keys))
    cells = ["key", "window", "id", F.round("score_lstm_autoencoder", 9).alias("score")]
    live, want = live.select(*cells), want.select(*cells)
    n = table.df.groupBy("key").count().selectExpr("sum(60 * ((count - 60) div 10 + 1)) AS n").first()["n"]
    assert live.count() == want.count() == n
    assert live.exceptAll(want).count() == 0 and live.where("score IS NOT NULL").count() == n // 60 * 49
    assert model.threshold == threshold


def test_thresholds_come_from_the_newest_version(spark):
    folder = scratch_path(spark, "versions")
    series = load_series(spark.createDataFrame([], SCHEMA), ["key"], "ts", "id", ["x"])
    scorer = StreamScorer(series, {}, folder)
    assert scorer._previous(spark, "thresholds", 5) is None
    for batch in (1, 3):
        scorer._write(threshold_table(spark, {"m": float(batch)}), "thresholds", batch)
    for batch, value in ((2, 1.0), (3, 1.0), (4, 3.0), (9, 3.0)):
        assert scorer._previous(spark, "thresholds", batch).first()["threshold"] == value


def test_stage_stats(spark):
    rows = spark.createDataFrame([(0, "addBatch", 1.0, 10), (1, "addBatch", 3.0, 30)], PROGRESS_SCHEMA)
    got = {r["stage"]: r for r in stage_stats(rows, ["addBatch", "walCommit"]).collect()}
    r = got["addBatch"]
    assert (r["mean_time"], r["max_time"], r["min_time"], r["std_time"], r["runs"]) == (2.0, 3.0, 1.0, 1.0, 2)
    assert r["rows_per_second"] == 10.0 and got["walCommit"]["runs"] == 0 and got["walCommit"]["mean_time"] == 0.0


def test_messages(spark):
    text = [json.dumps({"timestamp": "2024-03-01T10:00:00", "temperature": 21.5}), json.dumps({"vibration": 0.4})]
    out = records(spark.createDataFrame([(t,) for t in text], "value string"), READING).collect()
    assert out[0]["temperature"] == 21.5 and out[0]["timestamp"].hour == 10
    assert out[1]["timestamp"] is not None and out[1]["vibration"] == 0.4
    df = spark.createDataFrame(frame(3, ["a"]), SCHEMA)
    assert as_messages(df, "ts", "key").columns == ["key", "value"]
    assert kafka_options("h:1", "t", per_trigger=5)["maxOffsetsPerTrigger"] == "5"


def test_csv_round_trip(spark):
    df = spark.createDataFrame(frame(20, gaps=0.2), SCHEMA)
    path = scratch_path(spark, "csv")
    files.write_csv(df, path)
    back = files.read_csv(spark, path, SCHEMA, "ts")
    key = ["key", "id"]
    a, b = df.toPandas().sort_values(key), back.toPandas().sort_values(key)
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))
    inferred = files.read_csv(spark, path, ts="ts")
    assert dict(inferred.dtypes)["ts"] == "timestamp"



class Cell:
    """A state variable of one key."""

    def __init__(self):
        self.kept = None

    def exists(self):
        return self.kept is not None

    def get(self):
        return self.kept

    put = update = lambda self, value: setattr(self, "kept", value)


def test_windows_of_a_series_leave_in_bounded_strips(spark):
    live = load_series(spark.createDataFrame([], SCHEMA), ["key"], "ts", "id", ["x"])
    step = windows.CountWindows(("key",), ["ts", "id", "x"], ["ts", "id"], windows._row_type(live), 60, 10, "UTC")
    step.recent, step.seen = Cell(), Cell()
    n, at = 20_000, 0
    pdf = pd.DataFrame({"key": "a", "ts": pd.Timestamp("2024-03-01") + pd.to_timedelta(range(n), unit="s"), "id": range(n), "x": 1.0})
    # The first micro-batch is shorter than a window; the second comes in pieces, newest first.
    for pieces in ([pdf[:45]], [pdf[low : low + 1000] for low in range(19_045, 44, -1000)]):
        for frame_ in step.handleInputRows(("a",), iter(pieces), None):
            assert len(frame_) <= windows.STRIPS and frame_["_windows"].max() <= windows.STRIP
            assert frame_["id"].map(len).sum() <= windows.STRIPS * (10 * windows.STRIP + 60)
            for row in frame_.to_dict("records"):
                assert row["_first"] == at
                start = row["_first"] * 10
                assert list(row["id"]) == list(range(start, start + row["_windows"] * 10 + 50))
                assert row["ts"][0] == (pdf["ts"][start] - pd.Timestamp(0)) // pd.Timedelta("1us")
                at += row["_windows"]
    assert at == (n - 60) // 10 + 1 and step.seen.kept == (n,) and [r[1] for r in step.recent.kept] == list(range(n - 60, n))


def test_scored_windows_are_stored_once_and_side_by_side(spark, monkeypatch):
    """Nothing as wide as the features is checkpointed, and features are not shuffled to meet the scores of sequences."""
    from tidewatch.streaming import scoring

    kept, plans = [], []
    monkeypatch.setattr(scoring, "pinned", lambda df: kept.append(df.columns) or df)
    write = StreamScorer._write

    def seen(self, df, table, batch):
        if table == "predictions":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(self, df, table, batch)

    monkeypatch.setattr(StreamScorer, "_write", seen)
    pdf = frame(400)
    table = load_series(spark.createDataFrame(pdf, SCHEMA), ["key"], "ts", "id", ["x"])
    model = fit_sequence_reconstruction(table, ["x"], length=12)
    folder = scratch_path(spark, "stored")
    scorer = StreamScorer(table, {"lstm_autoencoder": model}, folder)
    scorer(windows.count_windows(table), 0)
    assert all("rows" in columns for columns in kept)
    left = plans[0].split("MapInArrow")[0]
    assert "Window" in left and not any("x_roll_mean_5" in line for line in left.splitlines() if "Exchange" in line)
    out = spark.read.parquet(f"{folder}/predictions")
    assert out.count() == 2 * 35 * 60 and "x_roll_mean_5" in out.columns and "_strip" not in out.columns
