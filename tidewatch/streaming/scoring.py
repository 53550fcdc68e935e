"""Scoring micro-batches, adapting thresholds, routing alerts: T2-T7.

Each micro-batch of windows is an ordinary DataFrame, so the batch plans for features, models and ensembles
apply as they are. What must outlive a micro-batch (thresholds, newest rows) is a small table per batch number
below one folder: batch b reads the version of b - 1 and writes version b, so a repeated batch writes the
same again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.scores import is_reconstruction
from tidewatch.models.base import FittedModel
from tidewatch.models.store import predict, thresholds_of
from tidewatch.operators import ensemble
from tidewatch.operators.detect import fallback_detector
from tidewatch.operators.project import append_recent
from tidewatch.plans.profiles import stream_features
from tidewatch.plans.series import Profile, Series
from tidewatch.session import pinned
from tidewatch.sources.messages import alert_columns
from tidewatch.streaming.windows import window_rows

WARM_UP = 4
# Windows that are kept side by side, and the column that numbers such strips.
NEIGHBOURS, STRIP = 64, "_strip"
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
CALIBRATION_ROWS, CALIBRATION_MINIMUM = 500, 100


@dataclass
class StreamScorer:
    """A `foreachBatch` function over count windows.

    `series` describes the stream (keys, time, tie, values); `folder` is on shared storage.
    """

    series: Series
    models: dict[str, FittedModel]
    folder: str
    on_alert: Callable[[DataFrame, int], None] | None = None
    warm_up: int = WARM_UP
    sensors: Iterable[str] = field(default_factory=tuple)

    def __call__(self, windows: DataFrame, batch: int) -> None:
        # All readers of the micro-batch share it, dealt so that features need no other shuffle and neighbours, which hold
        # the same readings, are stored side by side. Its blocks go when the batch is done.
        windows = windows.withColumn(STRIP, F.floor(F.col("window") / NEIGHBOURS))
        windows = windows.repartition(*self.series.keys, STRIP).persist()
        try:
            if not windows.count():
                return  # later batches read the version before
            self._process(windows, batch)
        finally:
            windows.unpersist()

    def _process(self, windows: DataFrame, batch: int) -> None:
        rows = self._window_series(windows)
        recent = self._remember(rows, windows, batch)
        scored, method, thresholds = self._scored(rows, recent, batch)
        # Features exist here only, as wide as they are: what follows reads the columns it needs of them. Where a join brings
        # scores to them, they stay where they are.
        spark = rows.df.sparkSession
        before = spark.conf.get(CO_PARTITION)
        spark.conf.set(CO_PARTITION, "false")
        try:
            self._write(scored.drop(STRIP), "predictions", batch)
        finally:
            spark.conf.set(CO_PARTITION, before)
        scored = spark.read.parquet(self._path("predictions", batch))
        if thresholds is not None:
            rate = scored.agg(F.avg("ensemble")).first()[0]
            self._write(ensemble.raised_thresholds(thresholds, F.lit(rate)), "thresholds", batch)
        alerts = alert_columns(
            scored, self.series.ts, "ensemble", method, "confidence",
            self.sensors or self.series.values, keep=[*self.series.keys, "window"],
        )
        self._write(alerts, "alerts", batch)
        if self.on_alert:
            alerts = spark.read.parquet(self._path("alerts", batch))
            self.on_alert(alerts.filter("is_anomaly"), batch)

    def _window_series(self, windows: DataFrame) -> Series:
        keys = (*self.series.keys, STRIP)
        rows = window_rows(windows, replace(self.series, keys=keys, _cache={}))
        # A window holds a fixed number of rows, so no series in here can be long.
        n = windows.count()
        size = windows.agg(F.max(F.size("rows"))).first()[0]
        return Series(rows.df, rows.keys, rows.ts, rows.tie, rows.values, known=Profile(n * size, n, size))

    def _write(self, df: DataFrame, table: str, batch: int) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self._path(table, batch))

    def _path(self, table: str, batch: int) -> str:
        return f"{self.folder}/{table}/batch={batch}"

    def _previous(self, spark: SparkSession, table: str, batch: int) -> DataFrame | None:
        """The newest version that a batch before this one left; None only if none of them left any."""
        for before in range(batch - 1, -1, -1):
            try:
                return spark.read.parquet(self._path(table, before))
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        return None

    def _remember(self, rows: Series, windows: DataFrame, batch: int) -> DataFrame:
        """Newest rows of every series; windows overlap, so a row is kept once, from its newest window.

        Features are worked out for the windows of these rows only."""
        s, spark = self.series, windows.sparkSession
        newest = Window.partitionBy(*s.keys).orderBy(*[F.col(c).desc() for c in s.order])
        ranked = rows.df.select(*rows.keys, *s.order).withColumn("_rank", F.dense_rank().over(newest))
        named = ranked.filter(F.col("_rank") <= CALIBRATION_ROWS).groupBy(*rows.keys).agg(F.count(F.lit(1)).alias("_held"))
        same = reduce(and_, [F.col(f"w.{k}").eqNullSafe(F.col(f"n.{k}")) for k in rows.keys])
        held = windows.alias("w").join(named.alias("n"), same, "left_semi")
        features = stream_features(self._window_series(pinned(held)))
        latest = F.max_by(F.struct(*[c for c in features.columns if c not in (*s.identity, STRIP)]), "window")
        once = features.groupBy(*s.identity).agg(latest.alias("_f")).select(*s.identity, "_f.*")
        stored = self._previous(spark, "recent", batch)
        known = once.limit(0) if stored is None else stored.join(once.select(*s.identity), s.identity, "left_anti")
        self._write(append_recent(s.with_df(known), once, CALIBRATION_ROWS), "recent", batch)
        return spark.read.parquet(self._path("recent", batch))

    def _scored(self, rows: Series, recent: DataFrame, batch: int) -> tuple[DataFrame, str, DataFrame | None]:
        """Scored rows, the method, and the thresholds that the rate of this batch may raise."""
        if not self.models:
            flags = fallback_detector(rows.df, rows.values, rows.keys, flag="_flag")
            out = flags.withColumn("pred_threshold_detector", F.col("_flag").cast("int")).drop("_flag")
            out = ensemble.combine(out, "majority_vote")
            return out.withColumn("confidence", F.lit(None).cast("double")), "threshold_detector", None
        spark = rows.df.sparkSession
        thresholds = thresholds_of(self.models)
        left = self._previous(spark, "thresholds", batch)
        if left is not None:
            thresholds |= ensemble.read_thresholds(left)
        # A reading is in several windows, and in each of them it ends a sequence of that window.
        scored = predict(self.models, stream_features(rows), keys=tuple(rows.keys), thresholds=thresholds)
        if batch < self.warm_up:
            self._write(ensemble.threshold_table(spark, thresholds), "thresholds", batch)
            out = ensemble.combine(ensemble.with_confidence(scored, thresholds), "weighted_vote")
            return ensemble.mean_confidence(out), "weighted_vote", None

        thresholds |= self._recalibrated(recent)
        out = ensemble.combine(ensemble.with_confidence(scored, thresholds), "confidence_weighted")
        return ensemble.mean_confidence(out), "confidence_weighted", ensemble.threshold_table(spark, thresholds)

    def _recalibrated(self, recent: DataFrame) -> dict[str, float]:
        """Percentile thresholds of reconstruction models from the newest rows over all series."""
        names = [n for n in self.models if is_reconstruction(n)]
        if not names or recent.limit(CALIBRATION_MINIMUM + 1).count() <= CALIBRATION_MINIMUM:
            return {}
        scored = predict(self.models, recent, names).withColumn("_all", F.lit("all"))
        whole = Series(scored, ("_all",), self.series.ts, self.series.tie, ())
        return ensemble.read_thresholds(ensemble.dynamic_thresholds(whole, names))


def start_scoring(windows: DataFrame, scorer: StreamScorer, checkpoint: str, once: bool = False):
    """Start the query; Spark's checkpoint keeps source progress and window state."""
    writer = windows.writeStream.foreachBatch(scorer).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
