"""How ordered series are laid out over tasks.

A window partitioned by the series key alone puts a whole series into one task. That is right for short
series and wrong for a key that holds a third of the table, so `arrange` looks at the profile first:

* every series fits `block_rows`: plain windows on the keys, one shuffle, nothing else;
* some do not: the long ones are cut into consecutive blocks of about `block_rows` rows. Rows are counted
  per time bucket (map-side combined, key and time columns only), buckets are packed into blocks by a
  running count over that small table, and each row is sent to its own block plus, for rows next to a
  border, to the neighbour as a halo copy. Windows then run on (keys, block) and halo rows are dropped.

Bucket widths follow each series' own time range; a bucket that is still too full (a burst, or one instant
with many readings) is cut at quantiles of its order values, and so is each part that is still too full, until
all fit; what holds one order value only is cut at quantiles of the tie. Positions are exact counts, never
estimates, so results do not depend on where the cuts fall.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.plans.series import Series, small_side
from tidewatch.session import pinned

BLOCK, CORE, FIRST = "_block", "_core", "_first"
BUCKETS_PER_BLOCK = 8
# Cuts of one over-full slot, and how often slots are cut again: enough for 2^54 parts of a bucket.
BURST_CUTS = 255
BURST_LEVELS = 6
# Bytes of a text tie, behind what all ties of a slot begin with, that one level of cuts tells apart.
TIE_BYTES = 6


@dataclass(frozen=True)
class Frames:
    """Window builders for one arrangement of rows."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    blocked: bool

    @property
    def group(self) -> list[str]:
        return [*self.keys, BLOCK] if self.blocked else list(self.keys)

    def rows(self, descending: bool = False) -> WindowSpec:
        cols = [F.col(c).desc() if descending else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*self.group).orderBy(*cols)

    def sql(self, descending: bool = False, rows: str = "") -> str:
        """The ordered window as SQL text; `rows` is the frame after ROWS BETWEEN."""
        part = ", ".join(f"`{c}`" for c in self.group)
        order = ", ".join(f"`{c}`{' DESC' if descending else ''}" for c in self.order)
        frame = f" ROWS BETWEEN {rows}" if rows else ""
        return f"(PARTITION BY {part} ORDER BY {order}{frame})"

    def last(self, n: int) -> WindowSpec:
        return self.rows().rowsBetween(-(n - 1), 0)

    def between(self, start: int, end: int) -> WindowSpec:
        return self.rows().rowsBetween(start, end)

    def so_far(self) -> WindowSpec:
        return self.rows().rowsBetween(Window.unboundedPreceding, 0)

    def position(self) -> Column:
        """1-based row number within the whole series."""
        here = F.row_number().over(self.rows()).cast("bigint")
        return here + F.col(FIRST) if self.blocked else here

    def strip(self, df: DataFrame) -> DataFrame:
        if not self.blocked:
            return df
        return df.filter(F.col(CORE)).drop(BLOCK, CORE, FIRST)


def order_code(series: Series) -> Column:
    """The order column as a number: microseconds for time, the value itself otherwise."""
    dtype = series.df.schema[series.ts].dataType
    c = F.col(series.ts)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_micros(c.cast("timestamp"))
    return c.cast("double")


def arrange(series: Series, before: int = 0, after: int = 0) -> tuple[DataFrame, Frames]:
    """Rows ready for windows, and the window builders that fit them."""
    blocked = series.profile().longest > series.block_rows
    frames = Frames(series.keys, tuple(series.order), blocked)
    if not blocked:
        return series.df, frames
    return _in_blocks(series, before, after), frames


def _in_blocks(series: Series, before: int, after: int) -> DataFrame:
    keys = list(series.keys)
    slots = _slots(series)
    targets, n_targets = _targets(slots, keys, series.block_rows, before, after, series._cache)
    rows = slots.tag(series.df)
    joined = rows.join(small_side(targets, n_targets), [*keys, "_bucket", "_slot"], "left")
    # Short series have no bucket and stay whole in block 0.
    return joined.select(
        *series.df.columns,
        F.coalesce(BLOCK, F.lit(0).cast("bigint")).alias(BLOCK),
        F.coalesce(CORE, F.lit(True)).alias(CORE),
        F.coalesce(FIRST, F.lit(0).cast("bigint")).alias(FIRST),
    )


@dataclass(frozen=True)
class _Slots:
    """Where the long series were cut: per-series ranges, levels of burst cuts, and counted slots."""

    keys: tuple[str, ...]
    code: Column
    tie: str | None
    long: DataFrame
    n_long: int
    levels: tuple[tuple[DataFrame, int], ...] = ()
    counts: DataFrame | None = None

    def bucketed(self, df: DataFrame, how: str) -> DataFrame:
        lo, hi, n = F.col("_lo"), F.col("_hi"), F.col("_buckets")
        share = F.when(hi > lo, (self.code - lo).cast("double") * n / (hi - lo).cast("double"))
        # An infinite order value has no share of the range; it goes last.
        share = F.nanvl(F.coalesce(share, F.lit(0.0)), (n - 1).cast("double"))
        bucket = F.least(F.floor(share).cast("bigint"), n - 1)
        bucket = F.when(n.isNotNull(), bucket)
        return df.join(small_side(self.long, self.n_long), list(self.keys), how).withColumn(
            "_bucket", bucket
        )

    def tag(self, df: DataFrame, how: str = "left") -> DataFrame:
        rows = self.bucketed(df, how).withColumn("_slot", F.lit(0).cast("bigint"))
        for cuts, n in self.levels:
            edges = [c for c in cuts.columns if c not in {*self.keys, "_bucket", "_slot"}]
            rows = rows.join(small_side(cuts, n), [*self.keys, "_bucket", "_slot"], "left")
            fine = _fine_code(rows, self.code, self.tie)
            # Below, at and above each cut: a value that fills slots by itself ends up alone.
            part = F.size(F.filter("_cuts", lambda c: c < fine)) + F.size(F.filter("_cuts", lambda c: c <= fine))
            part = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(part)
            slot = F.col("_slot") * (2 * BURST_CUTS + 2) + part
            rows = rows.withColumn("_slot", slot).drop(*edges)
        return rows

    def edges(self) -> list[Column]:
        found = [F.count(F.lit(1)).alias("_n"), F.min(self.code).alias("_from"), F.max(self.code).alias("_to")]
        return [*found, F.min(self.tie).alias("_tie_from"), F.max(self.tie).alias("_tie_to")] if self.tie else found


def _fine_code(rows: DataFrame, code: Column, tie: str | None) -> Column:
    """Non-decreasing in (order, tie) within a slot: the offset of the order value, or of the tie where the slot holds one
    order value only."""
    offset = (code - F.col("_from")).cast("double")
    return offset if tie is None else F.when(F.col("_from") == F.col("_to"), _tie_code(rows, tie)).otherwise(offset)


def _tie_code(rows: DataFrame, tie: str) -> Column:
    dtype = rows.schema[tie].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        low, own = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("_tie_from", tie))
        return (own - low).cast("double")
    if isinstance(dtype, T.StringType):
        same = "size(filter(sequence(1, length(_tie_from)), i -> left(_tie_from, i) = left(_tie_to, i)))"
        shared = f"CASE WHEN length(_tie_from) = 0 THEN 0 ELSE {same} END"
        behind = f"encode(substr(`{tie}`, {shared} + 1, {TIE_BYTES}), 'utf-8')"
        return F.expr(f"cast(conv(rpad(hex(substring({behind}, 1, {TIE_BYTES})), {2 * TIE_BYTES}, '0'), 16, 10) as double)")
    return F.col(tie).cast("double") - F.col("_tie_from").cast("double")


def _slots(series: Series) -> _Slots:
    if "slots" in series._cache:
        return series._cache["slots"]
    keys, size = list(series.keys), series.block_rows
    code = order_code(series)
    long = (
        series.df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_n"), F.min(code).alias("_lo"), F.max(code).alias("_hi")
        )
        .filter(F.col("_n") > size)
        .select(
            *keys,
            "_lo",
            "_hi",
            (F.ceil(F.col("_n") / F.lit(size)) * BUCKETS_PER_BLOCK).cast("bigint").alias("_buckets"),
        )
    )
    long = pinned(long)
    # At most rows / block_rows series can be long, so this table is small by construction.
    slots = _Slots(tuple(keys), code, series.tie, long, long.count())
    at = [*keys, "_bucket", "_slot"]
    share = [i / (BURST_CUTS + 1) for i in range(1, BURST_CUTS + 1)]
    while True:
        counts = pinned(slots.tag(series.df, "inner").groupBy(*at).agg(*slots.edges()))
        # Rows that agree in order and tie have no order to cut by.
        apart = F.col("_from") < F.col("_to")
        if slots.tie:
            apart = apart | (F.col("_tie_from") < F.col("_tie_to"))
        full = counts.filter((F.col("_n") > size) & apart).drop("_n")
        n_full = full.count()
        if not n_full or len(slots.levels) == BURST_LEVELS:
            break
        rows = slots.tag(series.df, "inner").join(small_side(full, n_full), at)
        cuts = F.array_distinct(F.percentile_approx(_fine_code(rows, code, slots.tie), share, 10_000))
        level = pinned(rows.groupBy(*at, *[c for c in full.columns if c not in at]).agg(cuts.alias("_cuts")))
        slots = replace(slots, levels=(*slots.levels, (level, n_full)))
    slots = replace(slots, counts=counts.select(*at, "_n"))
    series._cache["slots"] = slots
    return slots


def _targets(
    slots: _Slots, keys: list[str], size: int, before: int, after: int, cache: dict
) -> tuple[DataFrame, int]:
    """(keys, bucket, slot) -> the blocks its rows belong to, its own and those it is a halo of."""
    memo = ("targets", before, after)
    if memo in cache:
        return cache[memo]
    run = Window.partitionBy(*keys).orderBy("_bucket", "_slot")
    start = F.coalesce(
        F.sum("_n").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")
    )
    placed = slots.counts.withColumn("_start", start).withColumn(
        "_own", F.floor(F.col("_start") / F.lit(size)).cast("bigint")
    )
    # Block that holds a given position: slot starts and the asked-for positions in one ordered list.
    ends = placed.select(
        *keys,
        "_bucket",
        "_slot",
        F.explode(
            F.array(
                F.struct(F.col("_start").alias("at"), F.col("_own").alias("block"), F.lit("").alias("ask")),
                F.struct(
                    F.greatest(F.col("_start") - after, F.lit(0)).alias("at"),
                    F.lit(None).cast("bigint").alias("block"),
                    F.lit("low").alias("ask"),
                ),
                F.struct(
                    (F.col("_start") + F.col("_n") + F.lit(before - 1)).alias("at"),
                    F.lit(None).cast("bigint").alias("block"),
                    F.lit("high").alias("ask"),
                ),
            )
        ).alias("p"),
    )
    lookup = Window.partitionBy(*keys).orderBy("p.at", "p.ask").rowsBetween(
        Window.unboundedPreceding, 0
    )
    reach = (
        ends.withColumn("_seen", F.last("p.block", ignorenulls=True).over(lookup))
        .groupBy(*keys, "_bucket", "_slot")
        .agg(
            F.max(F.when(F.col("p.ask") == "low", F.col("_seen"))).alias("_low"),
            F.max(F.when(F.col("p.ask") == "high", F.col("_seen"))).alias("_high"),
        )
    )
    wide = placed.join(reach, [*keys, "_bucket", "_slot"]).select(
        *keys,
        "_bucket",
        "_slot",
        "_start",
        "_own",
        F.explode(F.sequence("_low", "_high")).alias(BLOCK),
    )
    first = Window.partitionBy(*keys, BLOCK)
    table = pinned(
        wide.select(
            *keys,
            "_bucket",
            "_slot",
            BLOCK,
            (F.col(BLOCK) == F.col("_own")).alias(CORE),
            F.min("_start").over(first).alias(FIRST),
        )
    )
    cache[memo] = (table, table.count())
    return cache[memo]
