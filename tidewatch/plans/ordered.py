"""Running totals and exact quantiles over sorted values, without one task holding them all."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.plans.layout import BLOCK, arrange
from tidewatch.plans.series import BLOCK_ROWS, Series, small_side
from tidewatch.session import pinned


def running_totals(
    df: DataFrame,
    keys: Iterable[str],
    order: str,
    measures: Iterable[str],
    block_rows: int = BLOCK_ROWS,
    tie: str | None = None,
) -> DataFrame:
    """Adds cum_{m} for every measure: its sum over rows of the group up to and including this one.

    Rows must be distinct in (keys, order, tie). Groups that fit a task use a plain running window; longer ones are
    cut into ordered blocks, and each block starts from the totals of the blocks before it.
    """
    keys, measures = list(keys), list(measures)
    series = Series(df, tuple(keys), order, tie, tuple(measures), block_rows)
    rows, frames = arrange(series)
    over = {f"cum_{m}": F.sum(m).over(frames.so_far()) for m in measures}
    out = rows.withColumns(over)
    if frames.blocked:
        before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        totals = rows.groupBy(*frames.group).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
        starts = totals.select(
            *frames.group, *[F.sum(f"_t_{m}").over(before).alias(f"_s_{m}") for m in measures]
        )
        facts = series.profile()
        n_blocks = facts.series + facts.rows // block_rows
        out = out.join(small_side(starts, n_blocks), frames.group, "left")
        out = out.withColumns(
            {f"cum_{m}": F.col(f"cum_{m}") + F.coalesce(F.col(f"_s_{m}"), F.lit(0)) for m in measures}
        ).drop(*[f"_s_{m}" for m in measures])
    return frames.strip(out)


def exact_quantile(
    df: DataFrame,
    column: str,
    q: float,
    keys: Iterable[str] = (),
    name: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Linearly interpolated quantile per group, exact at any size.

    Values are counted first (equal ones collapse map-side), ranks come from running totals, and the two
    neighbours of the wanted rank are picked by an aggregate.
    """
    name = name or column
    keys = list(keys)
    group = keys or ["_all"]
    known = df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    if not keys:
        known = known.withColumn("_all", F.lit(0))
    # Read several times below; the input, which may be a model's scores, is read once.
    counts = pinned(
        known.groupBy(*group, F.col(column).cast("double").alias("_v")).agg(
            F.count(F.lit(1)).alias("n")
        )
    )
    ranked = running_totals(counts, group, "_v", ["n"], block_rows)
    sizes = counts.groupBy(*group).agg(F.sum("n").alias("_size"))
    at = (F.col("_size") - 1) * F.lit(float(q))
    rows = ranked.join(sizes, group).withColumn("_at", at)
    # A value with running count c covers ranks c - n .. c - 1.
    low = F.min(F.when(F.col("cum_n") > F.floor("_at"), F.col("_v")))
    high = F.min(F.when(F.col("cum_n") > F.ceil("_at"), F.col("_v")))
    part = F.max(F.col("_at") - F.floor("_at"))
    return rows.groupBy(*group).agg((low + (high - low) * part).alias(name)).select(*keys, name)
