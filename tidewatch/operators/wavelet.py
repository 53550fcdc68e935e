"""Multilevel wavelet features: F2.

Each level is a polyphase filter over the arranged rows: an output is a sum of `lag`s at every second row, and the next
level looks twice as far back over the same rows. All levels and all statistics come out of one sorted layout, whose
blocks keep as many halo rows as the levels look back together, so no task ever needs a whole series. Edges are mirrored by
looking the other way. The zero padding up to a power of two is never materialised, but for the few rows behind the last
one that outputs still reach; band lengths follow from the padded length.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.missing import interpolate
from tidewatch.operators.neighbours import POSITION
from tidewatch.plans.doubling import extended
from tidewatch.plans.layout import BLOCK, CORE, FIRST, arrange
from tidewatch.plans.series import Series

# Daubechies db4 low-pass decomposition filter.
DB4_LOW = (
    -0.010597401784997278,
    0.032883011666982945,
    0.030841381835986965,
    -0.18703481171888114,
    -0.02798376941698385,
    0.6308807679295904,
    0.7148465705525415,
    0.23037781330885523,
)
WAVELETS = {"db4": DB4_LOW}
STATS = ("energy", "mean", "std", "max")


def high_pass(low: tuple[float, ...]) -> tuple[float, ...]:
    """Quadrature mirror of a low-pass filter."""
    return tuple((-1) ** (k + 1) * tap for k, tap in enumerate(reversed(low)))


def _lag(x: str, back: int, over: str) -> str:
    return f"lag({x}, {back}, 0D) OVER {over}" if back > 0 else f"lead({x}, {-back}, 0D) OVER {over}" if back else x


def _mirrored_end(x: str, i: str, n: str, taps: int, stride: int, over: str) -> str:
    """Behind its n samples a signal runs backwards for as many samples as a filter reaches, and is 0 from there."""
    cases = " ".join(f"WHEN {q} THEN {_lag(x, (2 * q + 1) * stride, over)}" for q in range(taps - 1))
    return f"CASE WHEN {i} < {n} THEN {x} ELSE coalesce(CASE {i} - {n} {cases} END, 0D) END"


def _filtered(x: str, i: str, n: str, taps: tuple[float, ...], stride: int) -> str:
    """The output at the odd place i: tap j times the sample at i - j. Before its first sample a signal runs backwards too.
    Samples are the columns `<x>_<offset>`, by how many samples they lie back."""

    def sample(place: int, j: int) -> str:
        # A place of -1 - m is that of sample m, if there is one.
        m = j - place - 1
        return f"CASE WHEN {m} < {n} THEN {_column(x, place - m)} ELSE 0D END" if m >= 0 else _column(x, j)

    def total(place: int) -> str:
        return " + ".join(f"{t!r}D * {sample(place, j)}" for j, t in enumerate(taps))

    reach = len(taps) - 1
    cases = " ".join(f"WHEN {p} THEN {total(p)}" for p in range(1, reach, 2))
    return f"CASE {i} {cases} ELSE {total(reach)} END"


def _column(x: str, back: int) -> str:
    return f"`{x}_{'b' if back >= 0 else 'f'}{abs(back)}`"


def _halo(level: int, taps: int) -> tuple[int, int]:
    """Rows that the last level looks back and ahead: every level looks back for its mirrored end and its taps."""
    reach = taps - 1
    doubled = 2**level - 1
    return doubled * (2 * reach - 1 + reach), doubled * max(reach - 3, 0)


def _levels(df: DataFrame, group: list[str], cols: list[str], low: tuple[float, ...], level: int) -> DataFrame:
    """Adds `_lo<l>_<c>` and `_hi<l>_<c>` for every level l: at rows whose place `at` gives an output of that level, the
    output, else NULL; and `_n<l>`, the outputs of the level. Rows are cut to the odd ones, as the others give none."""
    high, reach = high_pass(low), len(low) - 1
    over = f"(PARTITION BY {', '.join(f'`{g}`' for g in group)} ORDER BY at)"
    offsets = range(-max(reach - 3, 0), reach + 1)
    for step in range(1, level + 1):
        # Place i in the input of this level, and how many rows lie between neighbours there.
        i, n, stride = f"_i{step - 1}", f"_n{step - 1}", max(1, 2 ** (step - 2))
        ends = {f"_e{step}_{c}": _mirrored_end(f"`_x{step - 1}_{c}`", i, n, len(low), stride, over) for c in cols}
        df = extended(df, ends)
        cells = {_column(f"_e{step}_{c}", k).strip("`"): _lag(f"`_e{step}_{c}`", k * stride, over) for c in cols for k in offsets}
        df = extended(df, cells)
        here = f"pmod({i}, 2) = 1"
        if step == 1:
            df = df.where(here)
        place = {f"_i{step}": f"CASE WHEN {here} THEN ({i} - 1) div 2 END", f"_n{step}": f"({n} + {reach}) div 2"}
        df = extended(df, place)
        outputs = {}
        for c in cols:
            valid = f"CASE WHEN _i{step} < _n{step} THEN %s WHEN _i{step} IS NOT NULL THEN 0D END"
            outputs[f"_x{step}_{c}"] = valid % _filtered(f"_e{step}_{c}", i, n, low, stride)
            valid = f"CASE WHEN _i{step} < _n{step} THEN %s END"
            outputs[f"_hi{step}_{c}"] = valid % _filtered(f"_e{step}_{c}", i, n, high, stride)
        df = extended(df, outputs)
        df = df.drop(*ends, *[x.strip("`") for x in cells], *([f"_x{step - 1}_{c}" for c in cols]))
    last = {f"_lo_{c}": f"CASE WHEN _i{level} < _n{level} THEN `_x{level}_{c}` END" for c in cols}
    return extended(df, last)


def wavelet_bands(
    series: Series,
    columns: Iterable[str] | None = None,
    wavelet: str = "db4",
    level: int = 3,
) -> DataFrame:
    """Long form: one row per (series, column, band) with energy, mean, std, max.

    Series of fewer than 2**level rows are left out. A gap at the start of a series counts as 0.
    """
    if wavelet not in WAVELETS:
        raise ValueError(f"Unknown wavelet {wavelet!r}; choose from {list(WAVELETS)}")
    low, keys, cols = WAVELETS[wavelet], list(series.keys), series.columns(columns)
    filled = series.with_df(interpolate(series, cols, limit=None, ends=False))
    rows, frames = arrange(filled, *_halo(level, len(low)))
    rows = rows.withColumn(POSITION, frames.position())

    count = F.count(F.lit(1))
    sizes = series.df.groupBy(*keys).agg(count.alias("_rows")).filter(F.col("_rows") >= 2**level)
    padded = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("_rows").cast("double")))).cast("bigint").alias("_n0")
    rows = series.attach(rows, sizes.select(*keys, "_rows", padded), "inner")
    # Rows that outputs still reach stand behind the last one, or behind the padding where its mirrored end comes near.
    reach = len(low) - 1
    behind = F.least(F.col("_n0") - F.col("_rows"), F.lit(reach * 2**level)) + reach * (2**level - 1)
    place = F.col(POSITION) - 1
    places = F.when(F.col(POSITION) == F.col("_rows"), F.sequence(place, place + behind)).otherwise(F.array(place))
    rows = rows.withColumn("at", F.explode(places))
    start = {f"_x0_{c}": f"CASE WHEN at < _rows THEN coalesce(`{c}`, 0D) ELSE 0D END" for c in cols}
    core = [f"`{c}`" for c in rows.columns if c in {*frames.group, BLOCK, CORE, FIRST}]
    table = rows.selectExpr(*core, "at", "at AS _i0", "_n0", *[f"{sql} AS `{c}`" for c, sql in start.items()])
    table = frames.strip(_levels(table, frames.group, cols, low, level))

    # Bands are named from coarse to fine: the first level makes detail_<level>.
    named = [(f"_hi{step}_%s", f"detail_{level + 1 - step}", step) for step in range(1, level + 1)]
    named.append(("_lo_%s", "approx", level))
    cells, bands = [], []
    for c in cols:
        for column, band, step in named:
            v, name = F.col(column % c), f"{c}_{band}"
            cells += [F.sum(v * v).alias(f"energy_{name}"), F.sum(v).alias(f"total_{name}"), F.max(F.abs(v)).alias(f"max_{name}")]
            n = F.col(f"_n{step}")
            mean = F.col(f"total_{name}") / n
            spread = F.greatest(F.col(f"energy_{name}") / n - mean * mean, F.lit(0.0))
            stats = (F.col(f"energy_{name}").alias("energy"), mean.alias("mean"), F.sqrt(spread).alias("std"), F.col(f"max_{name}").alias("max"))
            bands.append(F.struct(F.lit(c).alias("name"), F.lit(band).alias("band"), *stats))
    counts = [F.max(f"_n{step}").alias(f"_n{step}") for step in range(1, level + 1)]
    return table.groupBy(*keys).agg(*counts, *cells).select(*keys, F.explode(F.array(*bands)).alias("_b")).select(*keys, "_b.*")


def wavelet_features(
    series: Series, columns: Iterable[str] | None = None, wavelet: str = "db4", level: int = 3
) -> DataFrame:
    """Wide form: one row per series with {c}_wavelet_{band}_{stat} columns."""
    cols = series.columns(columns)
    names = ["approx", *[f"detail_{i}" for i in range(1, level + 1)]]
    cells = [
        F.max(F.when((F.col("name") == c) & (F.col("band") == b), F.col(s))).alias(
            f"{c}_wavelet_{b}_{s}"
        )
        for c in cols
        for b in names
        for s in STATS
    ]
    return wavelet_bands(series, cols, wavelet, level).groupBy(*series.keys).agg(*cells)
