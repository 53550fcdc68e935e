"""Nearest non-missing value before and after every row, at any distance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.plans.doubling import extended
from tidewatch.plans.layout import BLOCK, Frames, arrange
from tidewatch.plans.series import Series, small_side

POSITION = "_pos"
_RUNNING = "UNBOUNDED PRECEDING AND CURRENT ROW"


def with_neighbours(
    series: Series, columns: list[str], following: bool = True
) -> DataFrame:
    """Adds `_prev_<c>` and `_next_<c>`, structs (p, v) of the nearest known row, and the row's `_pos`.

    Within one window partition this is the last value ignoring NULLs, in either direction; the backward look
    is a running frame over the reversed order, because a frame that is open towards the end would be
    evaluated anew for each row. A series in blocks also needs what lies beyond its block: each block's first and
    last known rows form a table of one row per block, the nearest ones of other blocks are found on that
    table and joined back.
    """
    rows, frames = arrange(series)
    df = rows.withColumn(POSITION, frames.position())
    df = extended(
        df,
        {
            f"_known_{c}": f"CASE WHEN `{c}` IS NOT NULL THEN named_struct('p', {POSITION}, 'v', `{c}`) END"
            for c in columns
        },
    )
    before, after = frames.sql(rows=_RUNNING), frames.sql(descending=True, rows=_RUNNING)
    over = {f"_prev_{c}": f"last(`_known_{c}`, true) OVER {before}" for c in columns}
    if following:
        over |= {f"_next_{c}": f"last(`_known_{c}`, true) OVER {after}" for c in columns}
    local = extended(df, over)
    if frames.blocked:
        local = _beyond_blocks(df, local, frames, series, columns, following)
    return frames.strip(local.drop(*[f"_known_{c}" for c in columns]))


def _beyond_blocks(
    df: DataFrame, local: DataFrame, frames: Frames, series: Series, columns: list[str], following: bool
) -> DataFrame:
    ends = []
    for c in columns:
        known = F.col(f"_known_{c}")
        ends += [F.max(known).alias(f"_last_{c}"), F.min(known).alias(f"_first_{c}")]
    by_block = Window.partitionBy(*frames.keys)
    earlier = by_block.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    later = by_block.orderBy(F.desc(BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
    carried = [
        F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_carry_prev_{c}") for c in columns
    ]
    if following:
        carried += [
            F.last(f"_first_{c}", ignorenulls=True).over(later).alias(f"_carry_next_{c}")
            for c in columns
        ]
    table = df.groupBy(*frames.group).agg(*ends).select(*frames.group, *carried)
    facts = series.profile()
    n_blocks = facts.series + facts.rows // series.block_rows
    joined = local.join(small_side(table, n_blocks), frames.group, "left")
    sides = ["prev", "next"] if following else ["prev"]
    merged = {
        f"_{side}_{c}": F.coalesce(F.col(f"_{side}_{c}"), F.col(f"_carry_{side}_{c}"))
        for c in columns
        for side in sides
    }
    return joined.withColumns(merged).drop(*[f"_carry_{s}_{c}" for c in columns for s in sides])
