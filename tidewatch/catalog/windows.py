"""Queries for windows, lags, fills, calendar and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.catalog.fixtures import (

    GAPPY_SQL,
    LONG_SQL,
    WIDE_COLUMNS,
    WIDE_SQL,
    gappy_series,
    long_series,
    shipments,
    table,
    wide_series,
)
from tidewatch.catalog.registry import query, r, rounded
from tidewatch.functions.clock import add_calendar, from_text, to_text
from tidewatch.functions.scores import any_of
from tidewatch.operators import missing, project
from tidewatch.operators.detect import sensor_summary
from tidewatch.operators.lags import lags
from tidewatch.operators.rolling import WINDOWS, roll, roll_pairs
from tidewatch.plans.series import load_series, numeric_columns

KEYS = ["event_type", "event_id"]
_IN_SQL = {
    "mean": "avg({c})",
    "std": "stddev_samp({c})",
    "min": "min({c})",
    "max": "max({c})",
    "median": "quantile_cont({c}, 0.5)",
    "skew": "skewness({c})",
    "kurt": "kurtosis({c})",
    "q25": "quantile_cont({c}, 0.25)",
    "q75": "quantile_cont({c}, 0.75)",
}


def _roll_sql(source: str, keys: str, order: str, ids: str, column: str, stats, windows) -> str:
    cells, frames = [], []
    for w in windows:
        frames.append(f"w{w} AS (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)")
        for s in stats:
            if s == "iqr":
                call = f"quantile_cont({column}, 0.75) OVER w{w} - quantile_cont({column}, 0.25) OVER w{w}"
            else:
                call = _IN_SQL[s].format(c=column) + f" OVER w{w}"
            full = f"CASE WHEN count({column}) OVER w{w} = {w} THEN {call} END"
            cells.append(r(full, f"{column}_roll_{s}_{w}"))
    return f"SELECT {ids}, {', '.join(cells)} FROM ({source}) WINDOW {', '.join(frames)}"


def _roll_query(name: str, stats: list[str], windows: list[int]):
    sql = _roll_sql(GAPPY_SQL, "event_type", "ts, event_id", "event_type, event_id", "value", stats, windows)

    @query(name, sql)
    def run(spark, sf):
        out = roll(gappy_series(spark, sf), ["value"], windows, stats)
        return rounded(out.drop("ts", "rn", "value"), KEYS)


_roll_query("roll_mean", ["mean"], list(WINDOWS))
_roll_query("roll_std", ["std"], list(WINDOWS))
_roll_query("roll_min_max", ["min", "max"], list(WINDOWS))
_roll_query("roll_median", ["median"], list(WINDOWS))
_roll_query("roll_skew", ["skew"], list(WINDOWS))
_roll_query("roll_kurt", ["kurt"], list(WINDOWS))
_roll_query("roll_quartiles", ["q25", "q75", "iqr"], list(WINDOWS))

_DAY = ["median", "q25", "q75", "iqr", "min", "max"]


@query(
    "roll_day_quantiles",
    _roll_sql(LONG_SQL, "event_type", "ts, event_id", "event_type, event_id", "value", _DAY, [240, 1440]),
)
def roll_day_quantiles(spark, sf):
    """Windows of a day of minutes."""
    out = roll(long_series(spark, sf), windows=[240, 1440], stats=_DAY)
    return rounded(out.drop("ts", "value"), KEYS)


@query(
    "roll_day_in_blocks",
    _roll_sql(
        "SELECT 'all' AS series, event_id, CAST(ts AS TIMESTAMP) AS ts, value FROM events", "series", "ts, event_id", "event_id", "value",
        ["median", "q25", "max"], [5, 500],
    ),
)
def roll_day_in_blocks(spark, sf):
    """Long and short windows side by side over one series, in blocks shorter than the window."""
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    out = roll(load_series(events, [], "ts", "event_id", ["value"], 400), windows=[5, 500], stats=["median", "q25", "max"])
    return rounded(out.drop("ts", "value", "series"), ["event_id"])


_ALL = ["mean", "std", "min", "max", "median", "skew", "kurt", "q25", "q75", "iqr"]


@query(
    "roll_all_by_user",
    _roll_sql(
        "SELECT user_id, event_id, ts, value FROM events", "user_id", "ts, event_id", "user_id, event_id",
        "value", _ALL, WINDOWS,
    ),
)
def roll_all_by_user(spark, sf):
    out = roll(long_series(spark, sf, "user_id"))
    return rounded(out.drop("ts", "value"), ["user_id", "event_id"])


@query(
    "roll_all_in_blocks",
    _roll_sql(LONG_SQL, "event_type", "ts, event_id", "event_type, event_id", "value", _ALL, [5, 60]),
)
def roll_all_in_blocks(spark, sf):
    """The layout for series too long for one task, forced by a small block size."""
    out = roll(long_series(spark, sf, block_rows=700), windows=[5, 60])
    return rounded(out.drop("ts", "value"), KEYS)


@query(
    "roll_shipments",
    _roll_sql(
        "SELECT l_suppkey, l_shipdate, l_orderkey * 16 + l_linenumber AS line, l_quantity FROM lineitem",
        "l_suppkey", "l_shipdate, line", "l_suppkey, line", "l_quantity", ["mean", "std", "min", "max"], [10, 30],
    ),
)
def roll_shipments(spark, sf):
    out = roll(shipments(spark, sf), ["l_quantity"], [10, 30], ["mean", "std", "min", "max"])
    return rounded(out.drop("l_shipdate", "l_quantity", "l_extendedprice"), ["l_suppkey", "line"])


def _pair_sql(window: int) -> str:
    cells = []
    for i, a in enumerate(WIDE_COLUMNS):
        for b in WIDE_COLUMNS[i + 1:]:
            n = f"count({a} + {b}) OVER w = {window}"
            cov = f"covar_samp({a}, {b}) OVER w"
            cells.append(r(f"CASE WHEN {n} THEN corr({a}, {b}) OVER w END", f"{a}_{b}_corr_{window}"))
            cells.append(r(f"CASE WHEN {n} THEN {cov} END", f"{a}_{b}_cov_{window}"))
    return f"""SELECT strftime(hour, '%Y-%m-%d %H') AS hour, {', '.join(cells)} FROM ({WIDE_SQL})
      WINDOW w AS (ORDER BY hour ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"""


@query("roll_corr_cov", _pair_sql(24))
def roll_corr_cov(spark, sf):
    out = roll_pairs(wide_series(spark, sf), window=24).drop("plant", *WIDE_COLUMNS)
    return rounded(out.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH")), ["hour"])


_LAGS = [1, 5, 10, 30]
_W = "(PARTITION BY event_type ORDER BY ts, event_id)"


def _lag_cells(kinds, filled: str) -> str:
    cells = []
    for k in _LAGS:
        if "lag" in kinds:
            cells.append(r(f"lag(value, {k}) OVER {_W}", f"value_lag_{k}"))
        if "pct_change" in kinds:
            base = f"lag({filled}, {k}) OVER {_W}"
            cells.append(r(f"CASE WHEN {base} <> 0 THEN {filled} / {base} - 1 END", f"value_pct_change_{k}"))
        if "diff" in kinds:
            cells.append(r(f"value - lag(value, {k}) OVER {_W}", f"value_diff_{k}"))
    return ", ".join(cells)


def _lag_query(name: str, kinds: list[str]):
    filled = f"""SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM ({GAPPY_SQL})"""
    sql = f"SELECT event_type, event_id, {_lag_cells(kinds, 'filled')} FROM ({filled})"

    @query(name, sql)
    def run(spark, sf):
        out = lags(gappy_series(spark, sf), lags=_LAGS, kinds=kinds)
        return rounded(out.drop("ts", "rn", "value"), KEYS)


_lag_query("lag", ["lag"])
_lag_query("pct_change", ["pct_change"])
_lag_query("diff", ["diff"])

# Previous and next known row of every row, for the fill oracles.
NEAR_SQL = f"""SELECT *,
    last_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER before AS p,
    last_value(value IGNORE NULLS) OVER before AS vp,
    first_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER after AS n,
    first_value(value IGNORE NULLS) OVER after AS vn
  FROM ({GAPPY_SQL})
  WINDOW before AS (PARTITION BY event_type ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    after AS (PARTITION BY event_type ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
INTERPOLATED = """CASE WHEN value IS NOT NULL THEN value
  WHEN vp IS NOT NULL AND vn IS NOT NULL THEN vp + (vn - vp) * least(rn - p, 5) / (n - p)
  WHEN vp IS NOT NULL THEN vp ELSE vn END"""


def _fill_query(name: str, cell: str, method: str, block_rows: int = 1_000_000):
    @query(name, f"SELECT event_type, event_id, {r(cell, 'value')} FROM ({NEAR_SQL})")
    def run(spark, sf):
        out = missing.handle_missing(gappy_series(spark, sf, block_rows), method, 5)
        return rounded(out.drop("ts", "rn"), KEYS)


_fill_query("interpolate", INTERPOLATED, "interpolate")
_fill_query("interpolate_in_blocks", INTERPOLATED, "interpolate", 500)
_fill_query("ffill", "coalesce(value, CASE WHEN rn - p <= 5 THEN vp END, vn)", "ffill")
_fill_query("bfill", "coalesce(value, CASE WHEN n - rn <= 5 THEN vn END, vp)", "bfill")
_fill_query("fill_zero", "coalesce(value, 0)", "zero")


@query("drop_incomplete_rows", f"SELECT event_type, event_id, value FROM ({GAPPY_SQL}) WHERE value IS NOT NULL")
def drop_incomplete_rows(spark, sf):
    return missing.handle_missing(gappy_series(spark, sf), "drop").drop("ts", "rn")


@query(
    "missing_count",
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_missing" for c in WIDE_COLUMNS)
    + ", " + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in WIDE_COLUMNS) + f" AS missing FROM ({WIDE_SQL})",
)
def missing_count(spark, sf):
    return missing.missing_count(wide_series(spark, sf).df, WIDE_COLUMNS)


@query("drop_incomplete_columns", f"SELECT event_type, event_id, rn FROM ({GAPPY_SQL})")
def drop_incomplete_columns(spark, sf):
    return missing.drop_incomplete_columns(gappy_series(spark, sf).df).drop("ts")


_CAL = {
    "hour_of_day": "hour(ts)", "day_of_week": "isodow(ts) - 1", "day_of_month": "day(ts)",
    "month_of_year": "month(ts)", "quarter": "quarter(ts)",
    "is_weekend": "CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END",
}
_CYC = {"hour": (_CAL["hour_of_day"], 24), "day": (_CAL["day_of_week"], 7), "month": (_CAL["month_of_year"], 12)}


@query(
    "calendar",
    "SELECT event_id, " + ", ".join(f"CAST({s} AS INTEGER) AS {n}" for n, s in _CAL.items()) + ", "
    + ", ".join(
        r(f"{fn}(2 * pi() * ({s}) / {n})", f"{name}_{fn}") for name, (s, n) in _CYC.items() for fn in ("sin", "cos")
    )
    + " FROM (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts FROM events)",
)
def calendar(spark, sf):
    out = add_calendar(table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), "ts")
    return rounded(out.drop("ts"), ["event_id"])


@query(
    "timestamp_text",
    "SELECT event_id, strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS text, true AS same FROM events",
)
def timestamp_text(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    df = df.withColumn("text", to_text("ts"))
    return df.select("event_id", "text", (from_text("text") == F.col("ts")).alias("same"))


@query("load_series", f"SELECT event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, value FROM ({LONG_SQL})")
def load(spark, sf):
    s = long_series(spark, sf)
    return s.df.select("event_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "value")


@query("numeric_columns", "SELECT event_id, user_id, value FROM events")
def numeric(spark, sf):
    df = table(spark, sf, "events")
    return df.select(*numeric_columns(df))


@query("select_features", "SELECT event_id, value FROM events")
def select_features(spark, sf):
    return project.select_features(table(spark, sf, "events"), ["event_id", "value"])


@query("drop_columns", "SELECT event_id, user_id, event_type, value FROM events")
def drop_columns(spark, sf):
    return project.drop_columns(table(spark, sf, "events"), ["ts", "props"])


@query(
    "include_original",
    f"SELECT event_type, event_id, value, {r(f'lag(value, 1) OVER {_W}', 'value_lag_1')} FROM ({LONG_SQL})",
)
def include_original(spark, sf):
    s = long_series(spark, sf)
    bare = lags(s, lags=[1], kinds=["lag"]).drop("value")
    return rounded(project.features_only(s, bare, include_original=True).drop("ts"), [*KEYS, "value"])


@query("align_columns", "SELECT event_id, CAST(0 AS DOUBLE) AS humidity, value FROM events")
def align_columns(spark, sf):
    return project.align_columns(table(spark, sf, "events"), ["humidity", "value"], ["event_id"])


@query(
    "any_of",
    f"SELECT strftime(hour, '%Y-%m-%d %H') AS hour, ({' OR '.join(f'coalesce({c} > 60, false)' for c in WIDE_COLUMNS)}) AS anomaly FROM ({WIDE_SQL})",
)
def any_flag(spark, sf):
    df = wide_series(spark, sf).df
    flag = any_of(*[F.col(c) > 60 for c in WIDE_COLUMNS])
    return df.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), flag.alias("anomaly"))


@query("flagged", "SELECT event_id, value FROM events WHERE value > 90")
def flagged(spark, sf):
    df = table(spark, sf, "events").withColumn("anomaly", F.col("value") > 90)
    return project.flagged(df).select("event_id", "value")


@query(
    "latest_reading",
    "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value "
    "FROM events GROUP BY user_id",
)
def latest_reading(spark, sf):
    return project.latest_reading(long_series(spark, sf, "user_id")).select("user_id", "event_id", "value")


@query("sensor_slice", f"SELECT strftime(hour, '%Y-%m-%d %H') AS hour, {r('click_', 'click_')} FROM ({WIDE_SQL})")
def sensor_slice(spark, sf):
    out = project.sensor_slice(wide_series(spark, sf), "click_")
    return rounded(out.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "click_"), ["hour"])


@query(
    "append_columns",
    f"""SELECT event_type, event_id, {r('value', 'value')}, {r(f'lag(value, 1) OVER {_W}', 'value_lag_1')},
      {r('CASE WHEN count(value) OVER w5 = 5 THEN avg(value) OVER w5 END', 'value_roll_mean_5')}
      FROM ({LONG_SQL}) WINDOW w5 AS (PARTITION BY event_type ORDER BY ts, event_id
        ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
)
def append_columns(spark, sf):
    s = long_series(spark, sf)
    a = lags(s, lags=[1], kinds=["lag"])
    b = roll(s, windows=[5], stats=["mean"]).drop("value")
    return rounded(project.append_columns(a, b, s.identity).drop("ts"), KEYS)


@query(
    "features_with_labels",
    "SELECT d.doc_id, d.n_chars, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def features_with_labels(spark, sf):
    features = table(spark, sf, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    return project.with_labels(features, labels, ["doc_id"])


@query(
    "sensor_summary",
    f"SELECT event_type, {r('avg(value)', 'value_mean')}, {r('min(value)', 'value_min')}, {r('max(value)', 'value_max')}, "
    f"{r('stddev_samp(value)', 'value_std')} FROM events GROUP BY event_type",
)
def summary(spark, sf):
    return rounded(sensor_summary(table(spark, sf, "events"), ["value"], ["event_type"]), ["event_type"])


_TAIL_SQL = """SELECT {keys} FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC)
  AS k FROM ({source})) WHERE k <= {n}"""


@query("tail", _TAIL_SQL.format(keys="event_type, event_id, value", source=LONG_SQL, n=100))
def tail(spark, sf):
    return project.tail(long_series(spark, sf), 100).drop("ts")


@query("append_recent", _TAIL_SQL.format(keys="event_type, event_id, value", source=LONG_SQL, n=500))
def append_recent(spark, sf):
    """Two halves of a month: stored rows and the batch that follows them."""
    s = long_series(spark, sf)
    cut = F.lit("2024-01-16").cast("timestamp")
    stored, batch = s.df.filter(F.col("ts") < cut), s.df.filter(F.col("ts") >= cut)
    return project.append_recent(s.with_df(stored), batch, 500).drop("ts")


@query(
    "sequences",
    f"""SELECT event_type, event_id, CAST(len(v) AS INTEGER) AS n, {r('v[1]', 'first')}, {r('v[60]', 'last')},
      {r('list_sum(v)', 'total')}
      FROM (SELECT event_type, event_id, list(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
        ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS v FROM ({LONG_SQL})) WHERE len(v) = 60""",
)
def sequences(spark, sf):
    out = project.sequences(long_series(spark, sf, block_rows=900), ["value"], 60)
    flat = F.flatten("sequence")
    out = out.select(
        "event_type", "event_id", F.size("sequence").alias("n"), F.element_at(flat, 1).alias("first"),
        F.element_at(flat, -1).alias("last"),
        F.aggregate(flat, F.lit(0.0), lambda a, x: a + x).alias("total"),
    )
    return rounded(out, KEYS)


