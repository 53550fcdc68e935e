"""Messages as JSON records, in streams and in tables: S4-S7, C7, C8."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.clock import from_text, to_text
from tidewatch.functions.scores import prediction_models

# The sensors of a reading and the fields of an alert.
SENSORS = ("temperature", "vibration", "pressure", "power_consumption")
READING = T.StructType(
    [T.StructField("timestamp", T.StringType())] + [T.StructField(s, T.DoubleType()) for s in SENSORS]
)


def records(df: DataFrame, schema: T.StructType, value: str = "value", ts: str = "timestamp", keep: Iterable[str] = ()) -> DataFrame:
    """JSON text to typed columns; a record without a time gets the current one."""
    parsed = df.select(*keep, F.from_json(F.col(value).cast("string"), schema).alias("_r"))
    fields = [F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields if f.name != ts]
    has_time = ts in schema.fieldNames()
    time = F.coalesce(from_text(F.col(f"_r.{ts}")), F.current_timestamp()) if has_time else F.current_timestamp()
    return parsed.select(*keep, time.alias(ts), *fields)


def as_messages(df: DataFrame, ts: str = "timestamp", key: str | None = None) -> DataFrame:
    """One JSON message per row, time as text; `key` also becomes the message key."""
    cells = [to_text(ts).alias(ts) if c == ts else F.col(c) for c in df.columns]
    value = F.to_json(F.struct(*cells)).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def alert_columns(
    df: DataFrame,
    ts: str = "timestamp",
    decision: str = "ensemble",
    method: str | Column = "weighted_vote",
    confidence: str = "confidence",
    sensors: Iterable[str] = SENSORS,
    keep: Iterable[str] = (),
) -> DataFrame:
    """The fields of an alert: time, decision, method, confidence, the vote of each model, the readings."""
    models = prediction_models(df.columns)
    votes = F.map_from_arrays(
        F.array(*[F.lit(m) for m in models]),
        F.array(*[F.col(f"pred_{m}") == 1 for m in models]),
    )
    return df.select(
        *keep,
        to_text(ts).alias("timestamp"),
        (F.col(decision) == 1).alias("is_anomaly"),
        (F.lit(method) if isinstance(method, str) else method).alias("ensemble_method"),
        F.col(confidence).alias("confidence"),
        votes.alias("model_predictions"),
        *[F.col(s).alias(f"sensor_{s}") for s in sensors],
    )


ALERT = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("ensemble_method", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("model_predictions", T.MapType(T.StringType(), T.BooleanType())),
    ]
)


def kafka_options(servers: str, topic: str, starting: str = "earliest", per_trigger: int | None = None) -> dict[str, str]:
    """Reader options of a topic. Progress lives in the query's checkpoint, not in committed offsets."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def stream_readings(
    spark: SparkSession,
    schema: T.StructType = READING,
    source: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    ts: str = "timestamp",
    keep: Iterable[str] = (),
) -> DataFrame:
    """Readings as a stream: JSON from a topic, or from text files below `path`.

    Topics need the Kafka connector on the class path.
    """
    reader = spark.readStream.format(source)
    if source == "text":
        reader = reader.schema("value string")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    raw = reader.load(path) if path else reader.load()
    return records(raw, schema, "value", ts, keep)


def stream_messages(
    df: DataFrame,
    checkpoint: str,
    sink: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    ts: str = "timestamp",
    key: str | None = None,
    once: bool = False,
):
    """Start writing rows as JSON messages to a topic or, for sink='text', to files."""
    writer = as_messages(df, ts, key if sink == "kafka" else None).writeStream.format(sink)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if path:
        writer = writer.option("path", path)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
