"""Windows over streams: by count (T1) and by event time (T9)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.plans.layout import Frames
from tidewatch.plans.ordered import running_totals
from tidewatch.plans.series import BLOCK_ROWS, Series, load_series
from tidewatch.session import STATE_STORE

SIZE, STEP = 60, 10
# Windows of a strip, and strips put out at once.
STRIP, STRIPS = 50, 16


def _row_type(series: Series) -> T.StructType:
    types = {f.name: f.dataType for f in series.df.schema.fields}
    return T.StructType([T.StructField(c, types[c]) for c in [*series.order, *series.values]])


def window_schema(series: Series) -> T.StructType:
    types = {f.name: f.dataType for f in series.df.schema.fields}
    return T.StructType(
        [T.StructField(k, types[k]) for k in series.keys]
        + [T.StructField("window", T.LongType()), T.StructField("rows", T.ArrayType(_row_type(series)))]
    )


def strip_schema(series: Series) -> T.StructType:
    """What the state operator puts out: neighbouring windows as the stretch of readings they share, column by column."""
    types = {f.name: f.dataType for f in series.df.schema.fields}
    plain = {c: T.LongType() if isinstance(types[c], T.TimestampType) else types[c] for c in [*series.order, *series.values]}
    return T.StructType(
        [T.StructField(k, types[k]) for k in series.keys]
        + [T.StructField("_first", T.LongType()), T.StructField("_windows", T.LongType())]
        + [T.StructField(c, T.ArrayType(t)) for c, t in plain.items()]
    )


def _in_order(columns: list[pd.Series]) -> np.ndarray:
    """Places of the rows in stable order, missing values last."""
    if all(c.dtype.kind in "iufM" for c in columns):
        return np.lexsort([c.to_numpy() for c in columns[::-1]])
    frame = pd.DataFrame(dict(enumerate(columns)))
    return frame.sort_values(list(frame.columns), kind="stable").index.to_numpy()


class CountWindows(StatefulProcessor):
    """Keeps the newest `size` readings of a series and a count; every `step` readings a window of them ends.

    State is bounded by `size` rows per series. Within a micro-batch readings are taken in (time, tie) order;
    across micro-batches in order of arrival. The readings of a series in one micro-batch are held as plain columns until
    they are in order; windows leave as strips of at most `STRIP` of them, which hold every reading once.
    """

    def __init__(self, keys: tuple, columns: list, order: list, row: T.StructType, size: int, step: int, zone: str):
        self.keys, self.columns, self.order = keys, columns, order
        self.row, self.size, self.step, self.zone = row, size, step, zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", self.row)
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pieces = {c: [] for c in self.columns}
        for batch in rows:
            for c in self.columns:
                pieces[c].append(batch[c])
        fresh = {c: pd.concat(pieces.pop(c), ignore_index=True) for c in self.columns}
        order = _in_order([fresh[c] for c in self.order])
        seen = self.seen.get()[0] if self.seen.exists() else 0
        kept = pd.DataFrame([tuple(r) for r in self.recent.get()] if self.recent.exists() else [], columns=self.columns)

        def stretch(low: int, high: int) -> pd.DataFrame:
            """Rows low, ..., high - 1 of those kept and, behind them, the fresh ones."""
            at = order[max(low - len(kept), 0) : max(high - len(kept), 0)]
            new = pd.DataFrame({c: fresh[c].iloc[at] for c in self.columns})
            old = kept.iloc[low:high]
            return new if old.empty else pd.concat([old, new], ignore_index=True)

        last, before = seen + len(order), seen - len(kept)
        # The first window that ends behind the readings seen earlier.
        window, done = max(-(-(seen + 1 - self.size) // self.step), 0), (last - self.size) // self.step
        while window <= done:
            out = []
            for first in range(window, min(window + STRIPS * STRIP, done + 1), STRIP):
                n = min(STRIP, done + 1 - first)
                low = first * self.step - before
                part = stretch(low, low + (n - 1) * self.step + self.size)
                out.append((*key, first, n, *(self._cells(part[c], c) for c in self.columns)))
            yield pd.DataFrame(out, columns=[*self.keys, "_first", "_windows", *self.columns])
            window += STRIPS * STRIP
        newest = stretch(max(len(kept) + len(order) - self.size, 0), len(kept) + len(order))
        self.recent.put([tuple(r) for r in newest.itertuples(index=False)])
        self.seen.update((last,))

    def _cells(self, values: pd.Series, column: str) -> np.ndarray | list:
        """Values for a column of arrays; times as microseconds."""
        kind, missing = self.row[column].dataType, values.isna().to_numpy()
        if isinstance(kind, T.TimestampType):
            zoned = pd.to_datetime(values).dt.tz_localize(self.zone, ambiguous=False)
            values = pd.Series(zoned.dt.tz_convert("UTC").dt.tz_localize(None).to_numpy().astype("datetime64[us]").astype(np.int64))
        elif isinstance(kind, T.IntegralType):
            values = values.where(~missing, 0).astype(np.int64)
        if not missing.any() and isinstance(kind, T.TimestampType | T.LongType | T.DoubleType):
            return values.to_numpy()
        return [None if gone else v for gone, v in zip(missing, values.tolist(), strict=True)]

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """Arbitrary state needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def stream_count_windows(series: Series, size: int = SIZE, step: int = STEP) -> DataFrame:
    """Streaming series to windows: (keys, window, rows), window 0 being the first full one."""
    spark = series.df.sparkSession
    use_state_store(spark)
    columns = [*series.order, *series.values]
    zone = spark.conf.get("spark.sql.session.timeZone")
    processor = CountWindows(series.keys, columns, series.order, _row_type(series), size, step, zone)
    strips = (
        series.df.select(*series.keys, *columns)
        .groupBy(*series.keys)
        .transformWithStateInPandas(
            statefulProcessor=processor,
            outputStructType=strip_schema(series),
            outputMode="Append",
            timeMode="None",
        )
    )
    each = strips.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_windows") - 1)))
    # Only the readings of one window are turned and zipped.
    cells = []
    for f in _row_type(series).fields:
        own = F.slice(f.name, (F.col("_at") * step + 1).cast("int"), size)
        cells.append(F.transform(own, F.timestamp_micros) if isinstance(f.dataType, T.TimestampType) else own)
    rows = F.arrays_zip(*cells).cast(T.ArrayType(_row_type(series))).alias("rows")
    return each.select(*series.keys, (F.col("_first") + F.col("_at")).alias("window"), rows)


def count_windows(series: Series, size: int = SIZE, step: int = STEP) -> DataFrame:
    """The same windows over a table."""

    def plan(df: DataFrame, frames: Frames) -> DataFrame:
        n = frames.position()
        members = F.collect_list(F.struct(*series.order, *series.values)).over(frames.last(size))
        df = df.withColumns({"_n": n, "rows": members})
        full = (F.col("_n") >= size) & ((F.col("_n") - size) % step == 0)
        helper = [c for c in df.columns if c in ("_block", "_core", "_first")]
        number = F.floor((F.col("_n") - size) / step).cast("bigint").alias("window")
        return df.filter(full).select(*series.keys, number, "rows", *helper)

    return series.transform_rows(plan, before=size - 1)


def window_rows(windows: DataFrame, series: Series) -> Series:
    """The readings of windows as short series keyed by (series, window)."""
    rows = windows.select(*series.keys, "window", F.explode("rows").alias("_r")).select(
        *series.keys, "window", "_r.*"
    )
    return Series(rows, (*series.keys, "window"), series.ts, series.tie, series.values, known=None)


def _grouped(df: DataFrame, keys: Iterable[str], frame: Column, aggregates: list[Column]) -> DataFrame:
    out = df.groupBy(*keys, frame.alias("_w")).agg(*aggregates)
    names = [c for c in out.columns if c not in {*keys, "_w"}]
    return out.select(*keys, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *names)


def event_time(df: DataFrame, ts: str, late: str | None) -> DataFrame:
    """Time as TIMESTAMP with a watermark: rows later than `late` behind the newest may be dropped."""
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, late) if late else df


def time_windows(
    df: DataFrame,
    ts: str,
    width: str,
    aggregates: list[Column],
    keys: Iterable[str] = (),
    slide: str | None = None,
    late: str | None = None,
) -> DataFrame:
    """Tumbling windows, or sliding ones with `slide`; the same call serves tables and streams."""
    keys = list(keys)
    frame = F.window(ts, width, slide) if slide else F.window(ts, width)
    return _grouped(event_time(df, ts, late), keys, frame, aggregates)


def session_windows(
    df: DataFrame,
    ts: str,
    gap: str,
    aggregates: list[Column],
    keys: Iterable[str] = (),
    late: str | None = None,
    tie: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Windows that end after a pause of `gap`.

    On a stream this is Spark's session window. On a table that operator would bring all rows of a key into
    one task, so sessions are numbered instead: a row after a pause starts one, the running total of starts is
    its number (in blocks for long series, see `plans.ordered`), and (key, number) is an ordinary group.
    """
    keys = list(keys)
    if df.isStreaming:
        return _grouped(event_time(df, ts, late), keys, F.session_window(ts, gap), aggregates)
    series = load_series(df, keys, ts, tie, [], block_rows)

    def starts(rows: DataFrame, frames: Frames) -> DataFrame:
        pause = f"`{ts}` >= lag(`{ts}`, 1) OVER {frames.sql()} + INTERVAL '{gap}'"
        return rows.withColumn("_start", F.expr(f"CASE WHEN coalesce({pause}, true) THEN 1L ELSE 0L END"))

    marked = series.transform_rows(starts, before=1)
    numbered = running_totals(marked, series.keys, ts, ["_start"], block_rows, tie)
    spans = [F.min(ts).alias("start"), (F.max(ts) + F.expr(f"INTERVAL '{gap}'")).alias("end")]
    out = numbered.groupBy(*series.keys, "cum__start").agg(*spans, *aggregates)
    return out.drop("cum__start", *([] if keys else series.keys))


def deduplicated(df: DataFrame, identity: Iterable[str], ts: str, late: str) -> DataFrame:
    """Each reading once, as far apart as `late`; state is dropped behind the watermark."""
    return event_time(df, ts, late).dropDuplicatesWithinWatermark(list(identity))
