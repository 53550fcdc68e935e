"""Series over the given tables, each with the SQL that makes the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch import Series, load_series
from tidewatch.plans.series import BLOCK_ROWS

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

LONG_SQL = "SELECT event_type, event_id, CAST(ts AS TIMESTAMP) AS ts, value FROM events"
GAPPY_SQL = f"""SELECT event_type, event_id, ts, rn,
  CASE WHEN rn % 7 = 0 OR rn % 50 < 8 THEN NULL ELSE value END AS value
  FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn
        FROM ({LONG_SQL}))"""
_PIVOT = ", ".join(f"avg(value) FILTER (WHERE event_type = '{t}') AS {t}_" for t in EVENT_TYPES)
WIDE_COLUMNS = [f"{t}_" for t in EVENT_TYPES]
WIDE_SQL = f"""SELECT 'all' AS plant, date_trunc('hour', CAST(ts AS TIMESTAMP)) AS hour, {_PIVOT}
  FROM events GROUP BY 1, 2"""
SCORED_SQL = """SELECT l.doc_id, l.toxic, l.quality, CAST(d.n_chars AS DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def long_series(spark: SparkSession, sf: str, key: str = "event_type", block_rows: int = BLOCK_ROWS) -> Series:
    df = table(spark, sf, "events").select(key, "event_id", "ts", "value")
    return load_series(df, [key], "ts", "event_id", ["value"], block_rows)


def gappy_series(spark: SparkSession, sf: str, block_rows: int = BLOCK_ROWS) -> Series:
    """Every seventh value missing, and runs of eight; positions come from the block layout."""
    series = long_series(spark, sf, block_rows=block_rows)
    df = series.transform_rows(lambda rows, frames: rows.withColumn("rn", frames.position()))
    rn = F.col("rn")
    gap = (rn % 7 == 0) | (rn % 50 < 8)
    return series.with_df(df.withColumn("value", F.when(~gap, F.col("value"))))


def wide_series(spark: SparkSession, sf: str) -> Series:
    """Hourly mean of each event type side by side."""
    df = table(spark, sf, "events")
    hourly = (
        df.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"))
        .pivot("event_type", EVENT_TYPES)
        .agg(F.avg("value"))
    )
    hourly = hourly.select(
        F.lit("all").alias("plant"), "hour", *[F.col(t).alias(f"{t}_") for t in EVENT_TYPES]
    )
    return load_series(hourly, ["plant"], "hour", None, WIDE_COLUMNS)


def shipments(spark: SparkSession, sf: str) -> Series:
    """Line items as one series per supplier."""
    df = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    # One tie-break column out of the two that name a line.
    tie = (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("line")
    df = df.select("l_suppkey", "l_shipdate", tie, "l_quantity", "l_extendedprice")
    return load_series(df, ["l_suppkey"], "l_shipdate", "line", ["l_quantity", "l_extendedprice"])


def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A fixed score and given truth: document length against the toxic label."""
    labels = table(spark, sf, "labels").select("doc_id", "toxic", "quality")
    documents = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return labels.join(documents, "doc_id")


def ordered(series: Series) -> Window:
    return Window.partitionBy(*series.keys).orderBy(*series.order)
