"""Trend, season and residual by centred moving average: W17, F3."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.missing import interpolate
from tidewatch.plans.doubling import Moments, add_summaries, summary
from tidewatch.plans.layout import Frames
from tidewatch.plans.series import Series, small_side

MODELS = ("additive", "multiplicative")


def _trend_plan(df: DataFrame, frames: Frames, columns: list[str], period: int) -> DataFrame:
    """Centred mean over one period; an even period uses half weights at both ends of period + 1 rows.

    The mean of the `period` rows up to row i + period // 2 is merged from halves (see `plans.doubling`) and
    read there with `lead`. For an even period the half-weighted mean is the average of two such means, one
    row apart, so the work per row does not grow with the period.
    """
    states = {c: Moments(c, 1) for c in columns}
    kept = [f"`{c}`" for c in df.columns]
    df = add_summaries(df, frames, list(states.values()), [period])
    half = period // 2
    over = frames.sql()
    cells = []
    for c, state in states.items():
        mean = summary(state, period, "m")
        ahead = f"lead({mean}, {half}) OVER {over}"
        if period % 2 == 0:
            before = f"lead({mean}, {half - 1}) OVER {over}" if half > 1 else mean
            cells.append(f"({ahead} + {before}) / 2D AS `{c}_trend`")
        else:
            cells.append(f"{ahead} AS `{c}_trend`")
    position = frames.position().alias("_at")
    return df.select(*[F.expr(k) for k in kept], *[F.expr(x) for x in cells], position)


def decompose(
    series: Series,
    columns: Iterable[str] | None = None,
    period: int = 1440,
    model: str = "additive",
) -> DataFrame:
    """Adds {c}_trend, {c}_seasonal, {c}_residual.

    Gaps are interpolated first. Series with fewer than two periods, with a gap at the start, or (for the
    multiplicative model) with values of 0 or less get NULL in all three columns.
    """
    if model not in MODELS:
        raise ValueError(f"Unknown model {model!r}; choose from {list(MODELS)}")
    if period < 2:
        raise ValueError("period must be at least 2 rows")
    cols = series.columns(columns)
    original = series.df.columns
    work = {c: f"_x_{c}" for c in cols}
    copies = series.df.withColumns({w: F.col(c) for c, w in work.items()})
    filled = interpolate(series.with_df(copies), list(work.values()), limit=None, ends=False)
    filled = series.with_df(filled)

    rows = filled.transform_rows(
        lambda df, frames: _trend_plan(df, frames, list(work.values()), period),
        before=period,
        after=period // 2,
    )
    additive = model == "additive"
    usable = {}
    for c, w in work.items():
        x, trend = F.col(w), F.col(f"{w}_trend")
        rest = x - trend if additive else F.try_divide(x, trend)
        usable[f"_rest_{c}"] = rest
    rows = rows.withColumns(usable | {"_phase": (F.col("_at") - 1) % period})

    keys = list(series.keys)
    sums = [F.avg(f"_rest_{c}").alias(f"_mean_{c}") for c in cols]
    for c, w in work.items():
        # Rows the reference method cannot handle: unfilled start, or non-positive values.
        bad = F.col(w).isNull() if additive else (F.col(w).isNull() | (F.col(w) <= 0))
        sums.append(F.max(bad.cast("int")).alias(f"_bad_{c}"))
    phases = rows.groupBy(*keys, "_phase").agg(F.count(F.lit(1)).alias("_n"), *sums)

    # The whole series' mean of phase means and its checks, from the (series x period) table.
    totals = [F.sum("_n").alias("_rows")]
    for c in cols:
        totals += [F.avg(f"_mean_{c}").alias(f"_level_{c}"), F.max(f"_bad_{c}").alias(f"_any_bad_{c}")]
    level = phases.groupBy(*keys).agg(*totals)
    profile = phases.join(small_side(level, series.profile().series), keys)
    cells = []
    for c in cols:
        m, lv = F.col(f"_mean_{c}"), F.col(f"_level_{c}")
        fits = (F.col("_rows") >= 2 * period) & (F.col(f"_any_bad_{c}") == 0)
        cells.append(F.when(fits, m - lv if additive else F.try_divide(m, lv)).alias(f"{c}_seasonal"))
    profile = profile.select(*keys, "_phase", *cells)

    n_profile = series.profile().series * period
    joined = rows.join(small_side(profile, n_profile), [*keys, "_phase"], "left")
    out = []
    for c, w in work.items():
        season, trend = F.col(f"{c}_seasonal"), F.col(f"{w}_trend")
        trend = F.when(season.isNotNull(), trend)
        rest = F.col(w) - trend - season if additive else F.try_divide(F.col(w), trend * season)
        out += [trend.alias(f"{c}_trend"), season, rest.alias(f"{c}_residual")]
    return joined.select(*original, *out)
