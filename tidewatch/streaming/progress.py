"""Timing of streaming stages: A10, T8."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROGRESS_SCHEMA = "batch bigint, stage string, seconds double, rows bigint"


def progress_rows(spark: SparkSession, progress: Iterable) -> DataFrame:
    """One row per (micro-batch, stage) out of a query's `recentProgress`, which Spark keeps bounded."""
    rows = []
    for p in progress:
        p = p if isinstance(p, dict) else p.jsonValue if hasattr(p, "jsonValue") else dict(p)
        for stage, ms in p["durationMs"].items():
            rows.append((int(p["batchId"]), stage, ms / 1000.0, int(p["numInputRows"])))
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def stage_stats(rows: DataFrame, stages: Iterable[str] | None = None) -> DataFrame:
    """Mean, max, min, deviation and count of stage durations, and rows per second.

    Named `stages` without any measurement show zeros.
    """
    stats = rows.groupBy("stage").agg(
        F.avg("seconds").alias("mean_time"),
        F.max("seconds").alias("max_time"),
        F.min("seconds").alias("min_time"),
        F.stddev_pop("seconds").alias("std_time"),
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(F.try_divide(F.sum("rows").cast("double"), F.sum("seconds")), F.lit(0.0)).alias("rows_per_second"),
    )
    if stages is None:
        return stats
    wanted = rows.sparkSession.createDataFrame([(s,) for s in stages], "stage string")
    return wanted.join(stats, "stage", "left").fillna(0)
