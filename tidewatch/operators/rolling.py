"""Row-window statistics: W1-W8 per column, W12-W13 per pair of columns."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

from pyspark.sql import DataFrame

from tidewatch.plans.doubling import CoMoments, Extremes, Moments, add_summaries, extended, summary
from tidewatch.plans.layout import Frames
from tidewatch.plans.orderstats import LONG_WINDOW, quantile_name, with_quantiles
from tidewatch.plans.series import Series

WINDOWS = (5, 10, 30, 60)
STATS = ("mean", "std", "min", "max", "median", "skew", "kurt", "q25", "q75", "iqr")
MOMENT_ORDER = {"mean": 1, "std": 2, "skew": 3, "kurt": 4}
QUANTILES = {"median": 0.5, "q25": 0.25, "q75": 0.75}


def roll_name(column: str, stat: str, window: int) -> str:
    return f"{column}_roll_{stat}_{window}"


def quantile_of_sorted(values: str, size: int, q: float) -> str:
    """Linearly interpolated quantile of a sorted array of known size, as SQL text."""
    at = q * (size - 1)
    low = int(at)
    part = at - low
    if part == 0:
        return f"{values}[{low}]"
    return f"{values}[{low}] + ({values}[{low + 1}] - {values}[{low}]) * {part!r}D"


def sorted_windows(
    df: DataFrame, frames: Frames, columns: list[str], windows: list[int]
) -> tuple[DataFrame, dict[tuple[str, int], str]]:
    """The sorted values of every complete window, NULL where one is incomplete.

    One list per column holds the newest max(windows) values, missing ones as NaN; smaller windows are slices
    of it. Sorting puts NaN last, so the last element tells whether a window is complete.
    """
    longest = max(windows)
    frame = frames.sql(rows=f"{longest - 1} PRECEDING AND CURRENT ROW")
    df = extended(
        df,
        {f"_ring_{c}": f"collect_list(coalesce(`{c}`, double('NaN'))) OVER {frame}" for c in columns},
    )
    cells, names = {}, {}
    for c in columns:
        ring = f"`_ring_{c}`"
        for w in windows:
            newest = ring if w == longest else f"slice({ring}, greatest(size({ring}) - {w - 1}, 1), {w})"
            cells[f"_all_{c}_{w}"] = f"CASE WHEN size({ring}) >= {w} THEN sort_array({newest}) END"
            names[c, w] = f"`_sorted_{c}_{w}`"
    df = extended(df, cells)
    whole = {
        f"_sorted_{c}_{w}": f"CASE WHEN NOT isnan(`_all_{c}_{w}`[{w - 1}]) THEN `_all_{c}_{w}` END"
        for c in columns
        for w in windows
    }
    return extended(df, whole), names


def rolling_median(df: DataFrame, frames: Frames, column: str, window: int) -> tuple[DataFrame, str]:
    """`df` with what the median of the newest `window` values needs, and its SQL."""
    if window > LONG_WINDOW:
        return with_quantiles(df, frames, [column], [window], [0.5]), f"`{quantile_name(column, window, 0.5)}`"
    df, cells = sorted_windows(df, frames, [column], [window])
    return df, quantile_of_sorted(cells[column, window], window, 0.5)


def roll_plan(
    df: DataFrame, frames: Frames, columns: list[str], windows: list[int], stats: list[str]
) -> DataFrame:
    """Moments and extremes by merging (see `plans.doubling`), order statistics from sorted windows, or, where windows are
    long, from ranks (see `plans.orderstats`)."""
    kept = [f"`{c}`" for c in df.columns]
    wanted = set(stats)
    order = max((MOMENT_ORDER[s] for s in wanted & set(MOMENT_ORDER)), default=0)
    needs_sort = bool(wanted & {*QUANTILES, "iqr"})
    moments = {c: Moments(c, order) for c in columns} if order else {}
    short = [w for w in windows if w <= LONG_WINDOW] if needs_sort else []
    long = [w for w in windows if w > LONG_WINDOW] if needs_sort else []
    if long:
        df = with_quantiles(df, frames, columns, long, list(QUANTILES.values()))
    merged = bool(wanted & {"min", "max"}) and len(short) < len(windows)
    extremes = {c: Extremes(c) for c in columns} if merged else {}
    states = [*moments.values(), *extremes.values()]
    if states:
        df = add_summaries(df, frames, states, windows)
    ordered: dict[tuple[str, int], str] = {}
    if short:
        df, ordered = sorted_windows(df, frames, columns, short)

    out = []
    for c in columns:
        for w in windows:
            cells: dict[str, str] = {}
            if order:
                cells |= moment_stats(moments[c], w)
            if c in extremes:
                cells |= {"min": summary(extremes[c], w, "lo"), "max": summary(extremes[c], w, "hi")}
            if w in long:
                cells |= _with_iqr({n: f"`{quantile_name(c, w, q)}`" for n, q in QUANTILES.items()})
            elif needs_sort:
                cells |= order_stats(ordered[c, w], w)
            out += [f"{cells[s]} AS `{roll_name(c, s, w)}`" for s in STATS if s in wanted]
    return df.selectExpr(*kept, *out)


def moment_stats(state: Moments, w: int) -> dict[str, str]:
    """Sample statistics out of central moment sums; a constant window has skewness 0 and kurtosis -3."""
    m = {f: summary(state, w, f) for f in state.fields}
    undefined = "CAST(NULL AS DOUBLE)"
    out = {"mean": m["m"]}
    if state.order >= 2:
        out["std"] = f"sqrt({m['s2']} / {w - 1}D)" if w >= 2 else undefined
    if state.order >= 3:
        bias = w * (w - 1) ** 0.5 / (w - 2) if w >= 3 else 0.0
        g1 = f"try_divide({m['s3']}, {m['s2']} * sqrt({m['s2']})) * {bias!r}D"
        out["skew"] = f"CASE WHEN {m['s2']} = 0 THEN 0D ELSE {g1} END" if w >= 3 else undefined
    if state.order >= 4:
        if w >= 4:
            lead = (w - 1) / ((w - 2) * (w - 3))
            b2 = f"try_divide({m['s4']}, {m['s2']} * {m['s2']}) * {float(w * (w + 1))!r}D"
            g2 = f"({b2} - {3.0 * (w - 1)!r}D) * {lead!r}D"
            out["kurt"] = f"CASE WHEN {m['s2']} = 0 THEN -3D ELSE {g2} END"
        else:
            out["kurt"] = undefined
    return out


def order_stats(values: str, w: int) -> dict[str, str]:
    out = _with_iqr({n: quantile_of_sorted(values, w, q) for n, q in QUANTILES.items()})
    return out | {"min": f"{values}[0]", "max": f"{values}[{w - 1}]"}


def _with_iqr(cells: dict[str, str]) -> dict[str, str]:
    return cells | {"iqr": f"({cells['q75']}) - ({cells['q25']})"}


def _checked(windows: Iterable[int]) -> list[int]:
    out = list(windows)
    if not out or any(int(w) != w or w < 1 for w in out):
        raise ValueError("windows must be positive row counts")
    return out


def roll(
    series: Series,
    columns: Iterable[str] | None = None,
    windows: Iterable[int] = WINDOWS,
    stats: Iterable[str] = STATS,
) -> DataFrame:
    """All rolling statistics of the chosen columns, NULL until a window holds `w` non-missing rows."""
    cols, sizes, chosen = series.columns(columns), _checked(windows), list(stats)
    unknown = [s for s in chosen if s not in STATS]
    if unknown:
        raise ValueError(f"Unknown statistics: {unknown}; choose from {list(STATS)}")
    return series.transform_rows(
        lambda df, frames: roll_plan(df, frames, cols, sizes, chosen), before=max(sizes) - 1
    )


def pair_plan(df: DataFrame, frames: Frames, pairs: list[tuple[str, str]], window: int) -> DataFrame:
    kept = df.columns
    states = {p: CoMoments(*p) for p in pairs}
    df = add_summaries(df, frames, list(states.values()), [window])
    out = []
    for (a, b), state in states.items():
        xx, yy, xy = (summary(state, window, f) for f in ("xx", "yy", "xy"))
        out.append(f"try_divide({xy}, sqrt({xx}) * sqrt({yy})) AS `{a}_{b}_corr_{window}`")
        out.append(f"try_divide({xy}, {window - 1}D) AS `{a}_{b}_cov_{window}`")
    return df.selectExpr(*[f"`{c}`" for c in kept], *out)


def roll_pairs(series: Series, columns: Iterable[str] | None = None, window: int = 60) -> DataFrame:
    """Rolling correlation and sample covariance of every pair of columns (i < j)."""
    cols = series.columns(columns)
    pairs = list(combinations(cols, 2))
    if not pairs:
        return series.df
    return series.transform_rows(
        lambda df, frames: pair_plan(df, frames, pairs, window), before=window - 1
    )
