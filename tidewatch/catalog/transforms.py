"""Queries for scaling, decomposition, spectra and wavelets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.catalog.fixtures import (
    LONG_SQL,
    SCORED_SQL,
    WIDE_COLUMNS,
    WIDE_SQL,
    long_series,
    scored_documents,
    shipments,
    table,
    wide_series,
)
from tidewatch.catalog.registry import query, r, rounded
from tidewatch.functions.scores import rescaled
from tidewatch.operators import scale as scaling
from tidewatch.operators.evaluate import normalised_scores
from tidewatch.operators.seasonal import decompose
from tidewatch.operators.spectral import spectral_features, top_frequencies
from tidewatch.operators.wavelet import DB4_LOW, high_pass, wavelet_bands

KEYS = ["event_type", "event_id"]
_ALL = "SELECT event_id, value, 5.0::DOUBLE AS flat FROM events"


def _flat(spark, sf):
    return table(spark, sf, "events").select("event_id", "value", F.lit(5.0).alias("flat"))


@query(
    "scale_standard",
    f"""SELECT event_id, {r('(value - avg(value) OVER ()) / stddev_pop(value) OVER ()', 'value')}, 0.0::DOUBLE AS flat
      FROM ({_ALL})""",
)
def scale_standard(spark, sf):
    return rounded(scaling.scale(_flat(spark, sf), ["value", "flat"], "standard"), ["event_id"])


@query(
    "scale_minmax",
    f"""SELECT event_id, {r('(value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ())', 'value')},
      0.0::DOUBLE AS flat FROM ({_ALL})""",
)
def scale_minmax(spark, sf):
    return rounded(scaling.scale(_flat(spark, sf), ["value", "flat"], "minmax"), ["event_id"])


@query(
    "scale_new_rows",
    f"""WITH fitted AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events WHERE ts < TIMESTAMP '2024-01-16')
      SELECT event_id, {r('(value - m) / s', 'value')} FROM events, fitted WHERE ts >= TIMESTAMP '2024-01-16'""",
)
def scale_new_rows(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    cut = F.lit("2024-01-16").cast("timestamp")
    fitted = scaling.fit_scaler(df.filter(F.col("ts") < cut), ["value"])
    again = scaling.Scaler.from_table(fitted.table(spark))
    return rounded(again.transform(df.filter(F.col("ts") >= cut)).drop("ts"), ["event_id"])


@query(
    "scale_by_series",
    f"""SELECT event_type, event_id, {r('''(value - avg(value) OVER (PARTITION BY event_type))
      / stddev_pop(value) OVER (PARTITION BY event_type)''', 'value')} FROM events""",
)
def scale_by_series(spark, sf):
    return rounded(scaling.scale_by_series(long_series(spark, sf)).drop("ts"), KEYS)


@query(
    "normalised_scores",
    f"SELECT doc_id, {r('(score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ())', 'score')} "
    f"FROM ({SCORED_SQL})",
)
def scores_normalised(spark, sf):
    return rounded(normalised_scores(scored_documents(spark, sf), "score").select("doc_id", "score"), ["doc_id"])


@query(
    "normalised_scores_by_series",
    f"""SELECT event_id, {r('''(value - min(value) OVER (PARTITION BY user_id))
      / (max(value) OVER (PARTITION BY user_id) - min(value) OVER (PARTITION BY user_id))''', 'score')} FROM events""",
)
def scores_by_series(spark, sf):
    s = long_series(spark, sf, "user_id")
    ends = s.df.groupBy("user_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    out = s.attach(s.df, ends).select("event_id", rescaled(F.col("value"), F.col("lo"), F.col("hi")).alias("score"))
    return rounded(out, ["event_id"])


PERIOD = 24
# Hourly series, gaps interpolated without a limit; a gap at the start is taken as it is.
_UNPIVOT = " UNION ALL ".join(f"SELECT '{c}' AS sensor, hour, {c} AS value FROM ({WIDE_SQL})" for c in WIDE_COLUMNS)
_FILLED = f"""SELECT sensor, hour, rn, CASE WHEN value IS NOT NULL THEN value
    WHEN vp IS NOT NULL AND vn IS NOT NULL THEN vp + (vn - vp) * (rn - p) / (n - p) ELSE vp END AS x
  FROM (SELECT *,
      last_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER before AS p,
      last_value(value IGNORE NULLS) OVER before AS vp,
      first_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER after AS n,
      first_value(value IGNORE NULLS) OVER after AS vn
    FROM (SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY hour) AS rn FROM ({_UNPIVOT}))
    WINDOW before AS (PARTITION BY sensor ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      after AS (PARTITION BY sensor ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def _decompose_sql(model: str) -> str:
    minus, div = ("-", "-") if model == "additive" else ("/", "/")
    whole = "count(*) OVER (PARTITION BY sensor)"
    bad = "x IS NULL" if model == "additive" else "x IS NULL OR x <= 0"
    return f"""WITH filled AS ({_FILLED}),
      good AS (SELECT *, max(CASE WHEN {bad} THEN 1 ELSE 0 END) OVER (PARTITION BY sensor) AS broken,
        {whole} AS n FROM filled),
      trended AS (SELECT *, CASE WHEN n >= {2 * PERIOD} AND broken = 0 AND count(x) OVER full_w = {PERIOD + 1}
          THEN (sum(x) OVER full_w - 0.5 * lag(x, {PERIOD // 2}) OVER o - 0.5 * lead(x, {PERIOD // 2}) OVER o) / {PERIOD}
          END AS trend FROM good
        WINDOW o AS (PARTITION BY sensor ORDER BY rn),
          full_w AS (PARTITION BY sensor ORDER BY rn ROWS BETWEEN {PERIOD // 2} PRECEDING AND {PERIOD // 2} FOLLOWING)),
      phases AS (SELECT sensor, (rn - 1) % {PERIOD} AS phase, avg(x {minus} trend) AS m FROM trended GROUP BY 1, 2),
      season AS (SELECT *, m {div} avg(m) OVER (PARTITION BY sensor) AS s FROM phases)
      SELECT t.sensor, strftime(hour, '%Y-%m-%d %H') AS hour, {r('trend', 'trend')}, {r('s', 'seasonal')},
        {r(f'x {minus} trend {div} s', 'residual')}
      FROM trended t JOIN season z ON t.sensor = z.sensor AND (t.rn - 1) % {PERIOD} = z.phase"""


def _decompose_query(model: str):
    @query(f"decompose_{model}", _decompose_sql(model))
    def run(spark, sf):
        out = decompose(wide_series(spark, sf), period=PERIOD, model=model)
        rows = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("sensor"), F.col(f"{c}_trend").alias("trend"),
                        F.col(f"{c}_seasonal").alias("seasonal"), F.col(f"{c}_residual").alias("residual"),
                    )
                    for c in WIDE_COLUMNS
                ]
            )
        )
        out = out.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), rows.alias("x")).select("hour", "x.*")
        return rounded(out, ["hour"])


_decompose_query("additive")
_decompose_query("multiplicative")

BLOCK = 64
# A DFT written out: every row of a block against every frequency, then summed per frequency.
_SPECTRUM = f"""WITH rows AS (SELECT event_type, (rn - 1) // {BLOCK} AS block, (rn - 1) % {BLOCK} AS t, value AS x
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM ({LONG_SQL}))),
  sizes AS (SELECT event_type, block, count(*) AS n FROM rows GROUP BY 1, 2),
  bins AS (SELECT event_type, block, n, unnest(range(0, n // 2 + 1)) AS k FROM sizes),
  dft AS (SELECT b.event_type, b.block, b.n, b.k, b.k / b.n::DOUBLE AS freq,
      sqrt(sum(x * cos(2 * pi() * k * t / n)) ** 2 + sum(x * sin(2 * pi() * k * t / n)) ** 2) AS mag
    FROM bins b JOIN rows r ON b.event_type = r.event_type AND b.block = r.block GROUP BY ALL),
  spec AS (SELECT *, mag * mag AS power, mag * mag / sum(mag * mag) OVER w AS share, max(freq) OVER w AS top
    FROM dft WINDOW w AS (PARTITION BY event_type, block))"""


@query(
    "spectral_features",
    f"""{_SPECTRUM} SELECT event_type, block, CAST(any_value(n) AS INTEGER) AS "rows",
      {r('arg_max(freq, mag)', 'value_dominant_freq')}, {r('arg_max(power, mag)', 'value_dominant_power', 2)},
      {r('-sum(share * log2(share + 1e-10))', 'value_spectral_entropy')},
      {r('sum(freq * share) / sum(share)', 'value_spectral_centroid')},
      {r('coalesce(sum(power) FILTER (WHERE freq <= top * 0.25), 0)', 'value_low_freq_energy', 2)},
      {r('coalesce(sum(power) FILTER (WHERE freq > top * 0.25 AND freq <= top * 0.75), 0)', 'value_mid_freq_energy', 2)},
      {r('coalesce(sum(power) FILTER (WHERE freq > top * 0.75), 0)', 'value_high_freq_energy', 2)}
      FROM spec GROUP BY event_type, block""",
)
def spectral(spark, sf):
    out = spectral_features(long_series(spark, sf), ["value"], block=BLOCK)
    coarse = [c for c in out.columns if c.endswith(("_power", "_energy"))]
    out = rounded(out, ["event_type", "block", *coarse])
    return rounded(out, [c for c in out.columns if c not in coarse], 2)


@query(
    "spectral_whole_series",
    f"""WITH rows AS (SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey
        ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1 AS t, l_quantity AS x FROM lineitem),
      sizes AS (SELECT l_suppkey, count(*) AS n FROM rows GROUP BY 1),
      bins AS (SELECT l_suppkey, n, unnest(range(0, n // 2 + 1)) AS k FROM sizes),
      dft AS (SELECT b.l_suppkey, b.n, b.k, b.k / b.n::DOUBLE AS freq,
          sum(x * cos(2 * pi() * ((k * t) % n) / n)) ** 2 + sum(x * sin(2 * pi() * ((k * t) % n) / n)) ** 2 AS power
        FROM bins b JOIN rows r ON b.l_suppkey = r.l_suppkey GROUP BY ALL)
      SELECT l_suppkey, {r('sum(freq * power) / sum(power)', 'centroid')},
        {r('arg_max(freq, power)', 'dominant_freq')} FROM dft GROUP BY l_suppkey""",
)
def spectral_whole(spark, sf):
    # Groups of at most 96 numbers: every series is transformed in steps.
    out = spectral_features(shipments(spark, sf), ["l_quantity"], whole_rows=128, piece=96)
    out = out.select(
        "l_suppkey", F.col("l_quantity_spectral_centroid").alias("centroid"),
        F.col("l_quantity_dominant_freq").alias("dominant_freq"),
    )
    return rounded(out, ["l_suppkey"])


@query(
    "top_frequencies",
    f"""{_SPECTRUM} SELECT event_type, block, CAST(k2 AS INTEGER) AS rank, {r('freq', 'freq')}, {r('mag', 'magnitude')}
      FROM (SELECT *, row_number() OVER (PARTITION BY event_type, block ORDER BY mag DESC, freq DESC) AS k2 FROM spec)
      WHERE k2 <= 5""",
)
def strongest(spark, sf):
    out = top_frequencies(long_series(spark, sf), "value", block=BLOCK, k=5)
    return rounded(out, ["event_type", "block", "rank"])


def _wavelet_sql(level: int = 3) -> str:
    taps = ", ".join(
        f"({j}, {a!r}::DOUBLE, {b!r}::DOUBLE)" for j, (a, b) in enumerate(zip(DB4_LOW, high_pass(DB4_LOW)))
    )
    ctes = [
        f"taps(j, lo, hi) AS (VALUES {taps})",
        f"""x0 AS (SELECT user_id, pos, x, CAST(2 ** ceil(log2(cnt)) AS BIGINT) AS n FROM
          (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, value AS x,
             count(*) OVER (PARTITION BY user_id) AS cnt FROM events) WHERE cnt >= {2 ** level}""" + ")",
    ]
    bands = []
    for i in range(1, level + 1):
        src = f"x{i - 1}"
        ctes.append(
            f"""e{i} AS (SELECT user_id, n, x, pos FROM {src} UNION ALL SELECT user_id, n, x, -pos - 1 FROM {src} WHERE pos < 7
              UNION ALL SELECT user_id, n, x, 2 * n - 1 - pos FROM {src} WHERE pos >= n - 7)"""
        )
        ctes.append(
            f"""o{i} AS (SELECT user_id, (n + 7) // 2 AS n, (pos + j - 1) // 2 AS pos, sum(x * lo) AS lo, sum(x * hi) AS hi
              FROM e{i}, taps WHERE (pos + j + 1) % 2 = 0 AND pos + j - 1 >= 0 AND (pos + j - 1) // 2 < (n + 7) // 2
              GROUP BY user_id, n, (pos + j - 1) // 2)"""
        )
        ctes.append(f"x{i} AS (SELECT user_id, n, pos, lo AS x FROM o{i})")
        bands.append((f"o{i}", "hi", f"detail_{level + 1 - i}"))
    bands.append((f"o{level}", "lo", "approx"))
    parts = [
        f"""SELECT user_id, '{name}' AS band, {r(f'sum({v} * {v})', 'energy')}, {r(f'sum({v}) / any_value(n)', 'mean')},
          {r(f'sqrt(greatest(sum({v} * {v}) / any_value(n) - (sum({v}) / any_value(n)) ** 2, 0))', 'std')},
          {r(f'max(abs({v}))', 'max')} FROM {t} GROUP BY user_id"""
        for t, v, name in bands
    ]
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(parts)


@query("wavelet_features", _wavelet_sql())
def wavelet(spark, sf):
    out = wavelet_bands(long_series(spark, sf, "user_id"), ["value"]).drop("name")
    return rounded(out, ["user_id", "band"])
