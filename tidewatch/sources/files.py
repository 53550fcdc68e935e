"""Files in and out: S2, S3, S8, S11."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, ts: str | None = None
) -> DataFrame:
    """CSV with a header. Give a schema for anything large; without one Spark reads the files twice.

    `ts` is parsed as a timestamp when it arrives as text.
    """
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    if ts and dict(df.dtypes)[ts] == "string":
        df = df.withColumn(ts, F.try_to_timestamp(ts))
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A directory of CSV part files with headers; timestamps keep their microseconds."""
    df.write.mode(mode).option("header", True).option("timestampFormat", TIME_PATTERN).csv(path)


def write_labels(df: DataFrame, path: str, on: Iterable[str], label: str = "label") -> None:
    """The label vector as a keyed table."""
    df.select(*on, F.col(label).cast("int").alias(label)).write.mode("overwrite").parquet(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_report(metrics: DataFrame, path: str) -> None:
    """A metrics table (see `operators.evaluate.evaluate_model`), one JSON record per line, split by model."""
    metrics.write.mode("overwrite").partitionBy("model").json(path)
