"""Queries for files, messages, feature sets and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import load_series
from tidewatch.catalog.detection import VOTES_SQL, votes
from tidewatch.catalog.fixtures import LONG_SQL, long_series, table, wide_series
from tidewatch.catalog.registry import query, r, rounded
from tidewatch.operators import ensemble
from tidewatch.plans.profiles import fallback_features, full_features, stream_features
from tidewatch.session import scratch_path
from tidewatch.sources import files
from tidewatch.sources.messages import ALERT, alert_columns, as_messages, records, stream_messages, stream_readings
from tidewatch.streaming import windows
from tidewatch.streaming.progress import progress_rows, stage_stats
from tidewatch.streaming.scoring import StreamScorer, start_scoring

EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
KEYS = ["event_type", "event_id"]


@query("csv_round_trip", "SELECT event_id, strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS at, user_id, event_type, value FROM events")
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    df = table(spark, sf, "events").drop("props").withColumn("ts", F.col("ts").cast("timestamp"))
    files.write_csv(df, path)
    back = files.read_csv(spark, path, EVENT_SCHEMA, "ts")
    return back.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "user_id", "event_type", "value")


@query("records_from_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, true AS has_time FROM events")
def records_from_json(spark, sf):
    schema = T.StructType([T.StructField("timestamp", T.StringType()), T.StructField("k", T.LongType())])
    out = records(table(spark, sf, "events"), schema, "props", keep=["event_id"])
    return out.select("event_id", "k", F.col("timestamp").isNotNull().alias("has_time"))


@query("messages_round_trip", "SELECT event_id, strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS at, value FROM events")
def messages_round_trip(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    schema = T.StructType().add("event_id", "long").add("ts", "string").add("value", "double")
    back = records(as_messages(df, "ts"), schema, "value", "ts")
    return back.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "value")


@query(
    "alert_messages",
    f"""SELECT event_id, strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
      CASE WHEN coalesce(pred_isolation_forest, 0) + coalesce(pred_random_forest, 0) * 1.5 + coalesce(pred_lstm_autoencoder, 0) * 2.0
        > (2.5 + CASE WHEN pred_lstm_autoencoder IS NULL THEN 0 ELSE 2.0 END) / 2 THEN true ELSE false END AS is_anomaly,
      'weighted_vote' AS ensemble_method, {r('1 / (1 + exp(-5 * (value - 55) / (55 + 1e-10)))', 'confidence')},
      pred_isolation_forest = 1 AS forest_vote, pred_lstm_autoencoder = 1 AS sequence_vote, value AS sensor_value FROM ({VOTES_SQL})""",
)
def alert_messages(spark, sf):
    rows = ensemble.with_confidence(votes(spark, sf), {"isolation_forest": 55.0})
    rows = ensemble.mean_confidence(ensemble.combine(rows, "weighted_vote"))
    alerts = alert_columns(rows, "ts", sensors=["value"], keep=["event_id"])
    schema = T.StructType([T.StructField("event_id", T.LongType()), *ALERT.fields, T.StructField("sensor_value", T.DoubleType())])
    text = alerts.select(F.to_json(F.struct("*")).alias("value"))
    back = text.select(F.from_json("value", schema).alias("m")).select("m.*")
    back = back.withColumns(
        {"forest_vote": F.col("model_predictions")["isolation_forest"], "sequence_vote": F.col("model_predictions")["lstm_autoencoder"]}
    )
    return rounded(back.drop("model_predictions"), ["sensor_value"])


@query("labels_round_trip", "SELECT doc_id, toxic FROM labels")
def labels_round_trip(spark, sf):
    path = scratch_path(spark, "labels")
    files.write_labels(table(spark, sf, "labels"), path, ["doc_id"], "toxic")
    return files.read_labels(spark, path)


def _window_sql(source: str, keys: str, windows_: list[int], lags: list[int], stats: bool) -> str:
    order = f"PARTITION BY {keys} ORDER BY ts, event_id"
    cells = []
    for w in windows_:
        frame = f"({order} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        calls = {"mean": "avg(value)", "std": "stddev_samp(value)", "min": "min(value)", "max": "max(value)"}
        for s, call in calls.items():
            full = f"coalesce(CASE WHEN count(value) OVER {frame} = {w} THEN {call} OVER {frame} END, 0)"
            cells.append(r(full, f"value_roll_{s}_{w}"))
    for k in lags:
        cells.append(r(f"coalesce(lag(value, {k}) OVER ({order}), 0)", f"value_lag_{k}"))
        cells.append(r(f"coalesce(value - lag(value, {k}) OVER ({order}), 0)", f"value_diff_{k}"))
    return f"SELECT {keys}, event_id, {', '.join(cells)} FROM ({source})"


@query("fallback_features", _window_sql(LONG_SQL, "event_type", [5, 10, 20], [1, 5, 10], True))
def fallback(spark, sf):
    return rounded(fallback_features(long_series(spark, sf)).drop("ts", "value"), KEYS)


@query("full_feature_table")
def full(spark, sf):
    """All features of the hourly table, filled and scaled; one day as the season."""
    return full_features(wide_series(spark, sf), period=24)


@query("stream_feature_table")
def stream_set(spark, sf):
    return stream_features(wide_series(spark, sf))


# The parquet file as a stream: one micro-batch per file, results on shared storage.
_RAW = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _stream(spark, sf: str) -> DataFrame:
    raw = spark.readStream.schema(_RAW).option("pathGlobFilter", "events.parquet").parquet(sf)
    return raw.select("event_type", "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value")


def _finished(spark, df: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream to its end and read what it wrote."""
    out = scratch_path(spark, label)
    writer = df.writeStream.option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True)
    if mode == "append":
        running = writer.format("parquet").option("path", out).start()
    else:
        # The whole result so far replaces the one before; repeating a batch changes nothing.
        def replace(rows: DataFrame, batch: int) -> None:
            rows.write.mode("overwrite").parquet(out)

        running = writer.outputMode(mode).foreachBatch(replace).start()
    running.awaitTermination()
    return spark.read.parquet(out)


def stream_series(spark, sf):
    return load_series(_stream(spark, sf).drop("user_id"), ["event_type"], "ts", "event_id", ["value"])


_WINDOWS_SQL = f"""SELECT event_type, (rn - 60) // 10 AS "window", CAST(len(v) AS INTEGER) AS n, ids[1] AS first_id, ids[60] AS last_id,
  {r('list_sum(v)', 'total')} FROM (SELECT event_type, row_number() OVER o AS rn, list(value) OVER w AS v, list(event_id) OVER w AS ids
    FROM ({LONG_SQL}) WINDOW o AS (PARTITION BY event_type ORDER BY ts, event_id),
      w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))
  WHERE rn >= 60 AND (rn - 60) % 10 = 0"""


def _described(found: DataFrame) -> DataFrame:
    ids = F.col("rows.event_id")
    total = F.aggregate("rows.value", F.lit(0.0), lambda a, x: a + x)
    out = found.select(
        "event_type", "window", F.size("rows").alias("n"), ids[0].alias("first_id"), ids[59].alias("last_id"), total.alias("total")
    )
    return rounded(out, ["event_type"])


@query("count_windows", _WINDOWS_SQL)
def batch_windows(spark, sf):
    return _described(windows.count_windows(long_series(spark, sf, block_rows=900)))


@query("stream_count_windows", _WINDOWS_SQL)
def streamed_windows(spark, sf):
    return _described(_finished(spark, windows.stream_count_windows(stream_series(spark, sf)), "windows"))


_MEMBERS_SQL = f"""SELECT w.event_type, w.n AS "window", x.event_id, x.ts, x.value
  FROM (SELECT event_type, rn, (rn - 60) // 10 AS n FROM (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn
      FROM ({LONG_SQL})) WHERE rn >= 60 AND (rn - 60) % 10 = 0) w
  JOIN (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM ({LONG_SQL})) x
    ON w.event_type = x.event_type AND x.rn BETWEEN w.rn - 59 AND w.rn"""


@query("stream_window_features", _window_sql(_MEMBERS_SQL, 'event_type, "window"', [5, 20], [1, 10], True))
def streamed_features(spark, sf):
    """Windows from keyed state, then the stream feature set on each of them."""
    s = stream_series(spark, sf)
    found = _finished(spark, windows.stream_count_windows(s), "windows")
    out = stream_features(windows.window_rows(found, s))
    names = [f"value_roll_{x}_{w}" for w in (5, 20) for x in ("mean", "std", "min", "max")]
    names += [f"value_{x}_{k}" for k in (1, 10) for x in ("lag", "diff")]
    return rounded(out.select("event_type", "window", "event_id", *names), ["event_type", "window", "event_id"])


def _stats() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max("value").alias("top")]


def _bucket_sql(width: str, starts: str, source: str) -> str:
    return f"""SELECT event_type, strftime(s, '%Y-%m-%d %H:%M') AS start, strftime(s + INTERVAL '{width}', '%Y-%m-%d %H:%M') AS "end",
      count(*) AS n, {r('sum(value)', 'total')}, {r('max(value)', 'top')} FROM (SELECT *, {starts} AS s FROM ({source})) GROUP BY event_type, s"""


_TUMBLING = _bucket_sql("6 hours", "time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')", LONG_SQL)
_SLIDING = _bucket_sql(
    "6 hours", "unnest([h, h - INTERVAL '2 hours', h - INTERVAL '4 hours'])",
    f"SELECT *, time_bucket(INTERVAL '2 hours', ts, TIMESTAMP '1970-01-01') AS h FROM ({LONG_SQL})",
)
_SESSIONS = f"""SELECT event_type, strftime(min(ts), '%Y-%m-%d %H:%M') AS start,
    strftime(max(ts) + INTERVAL '30 minutes', '%Y-%m-%d %H:%M') AS "end", count(*) AS n, {r('sum(value)', 'total')}, {r('max(value)', 'top')}
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY event_type ORDER BY ts) AS session FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh
    FROM ({LONG_SQL}))) GROUP BY event_type, session"""


def _dated(df: DataFrame) -> DataFrame:
    out = df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm") for c in ("start", "end")})
    return rounded(out, ["event_type"])


@query("tumbling_windows", _TUMBLING)
def tumbling(spark, sf):
    return _dated(windows.time_windows(long_series(spark, sf).df, "ts", "6 hours", _stats(), ["event_type"]))


@query("sliding_windows", _SLIDING)
def sliding(spark, sf):
    return _dated(windows.time_windows(long_series(spark, sf).df, "ts", "6 hours", _stats(), ["event_type"], slide="2 hours"))


@query("session_windows", _SESSIONS)
def sessions(spark, sf):
    df = long_series(spark, sf).df
    return _dated(windows.session_windows(df, "ts", "30 minutes", _stats(), ["event_type"], tie="event_id"))


@query("session_windows_in_blocks", _SESSIONS)
def sessions_in_blocks(spark, sf):
    df = long_series(spark, sf).df
    out = windows.session_windows(df, "ts", "30 minutes", _stats(), ["event_type"], tie="event_id", block_rows=300)
    return _dated(out)


@query("stream_tumbling_windows", _TUMBLING)
def stream_tumbling(spark, sf):
    df = windows.time_windows(_stream(spark, sf), "ts", "6 hours", _stats(), ["event_type"], late="1 day")
    return _dated(_finished(spark, df, "tumbling", "complete"))


@query("stream_session_windows", _SESSIONS)
def stream_sessions(spark, sf):
    df = windows.session_windows(_stream(spark, sf), "ts", "30 minutes", _stats(), ["event_type"], late="1 day")
    return _dated(_finished(spark, df, "sessions", "complete"))


@query("stream_deduplicated", "SELECT event_type, event_id, value FROM events")
def stream_deduplicated(spark, sf):
    """Every reading sent twice, kept once."""
    twice = _stream(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    df = windows.deduplicated(twice, ["event_id"], "ts", "1 day")
    return _finished(spark, df, "deduplicated").select("event_type", "event_id", "value")


@query("stream_messages", "SELECT event_id, event_type, value FROM events")
def streamed_messages(spark, sf):
    """Readings to JSON messages by one stream, and back by another."""
    out = scratch_path(spark, "messages")
    rows = _stream(spark, sf).select("event_id", "ts", "event_type", "value")
    stream_messages(rows, f"{out}-sent", "text", path=out, ts="ts", once=True).awaitTermination()
    schema = T.StructType().add("event_id", "long").add("ts", "string").add("event_type", "string").add("value", "double")
    back = stream_readings(spark, schema, "text", path=out, ts="ts")
    return _finished(spark, back, "received").select("event_id", "event_type", "value")


@query(
    "stream_fallback_alerts",
    f"""SELECT event_type, "window", coalesce(value > m + 3 * d OR value < m - 3 * d, false) AS is_anomaly,
      'threshold_detector' AS ensemble_method, value AS sensor_value
      FROM (SELECT *, avg(value) OVER w AS m, stddev_pop(value) OVER w AS d FROM ({_MEMBERS_SQL})
        WINDOW w AS (PARTITION BY event_type, "window"))""",
)
def stream_alerts(spark, sf):
    """Windows scored without any model: the rule that stands in for them."""
    s = stream_series(spark, sf)
    out = scratch_path(spark, "alerts")
    scorer = StreamScorer(s, {}, out)
    start_scoring(windows.stream_count_windows(s), scorer, f"{out}-checkpoint", once=True).awaitTermination()
    alerts = spark.read.parquet(f"{out}/alerts")
    return alerts.select("event_type", "window", "is_anomaly", "ensemble_method", "sensor_value")


@query("stage_stats")
def stages(spark, sf):
    """Durations of a stream's stages, from its own progress reports."""
    df = windows.time_windows(_stream(spark, sf), "ts", "6 hours", _stats(), ["event_type"], late="1 day")
    out = scratch_path(spark, "stages")
    running = (
        df.writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return stage_stats(progress_rows(spark, running.recentProgress))


