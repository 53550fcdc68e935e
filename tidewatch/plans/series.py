"""The series handle: a frame plus what makes its rows an ordered series."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows one task may be asked to order. A series above this is cut into blocks.
BLOCK_ROWS = 1_000_000
# A per-series table with at most this many rows may be broadcast.
BROADCAST_CELLS = 2_000_000


@dataclass(frozen=True)
class Profile:
    """Size facts of a frame, gathered in one pass over its key columns."""

    rows: int
    series: int
    longest: int


@dataclass(frozen=True)
class Series:
    """`df` holds one row per (`keys`, `ts`, `tie`); `values` are the measured columns."""

    df: DataFrame
    keys: tuple[str, ...]
    ts: str
    tie: str | None
    values: tuple[str, ...]
    block_rows: int = BLOCK_ROWS
    known: Profile | None = None
    _cache: dict = field(default_factory=dict, repr=False, compare=False)

    @property
    def order(self) -> list[str]:
        return [self.ts] + ([self.tie] if self.tie else [])

    @property
    def identity(self) -> list[str]:
        """Columns that name a row."""
        return [*self.keys, *self.order]

    def profile(self) -> Profile:
        """Row counts per series, reduced to three numbers. Runs once per handle."""
        if self.known:
            return self.known
        if "profile" not in self._cache:
            per_series = self.df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"))
            row = per_series.agg(
                F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))
            ).first()
            self._cache["profile"] = Profile(*row)
        return self._cache["profile"]

    def with_df(self, df: DataFrame, values: Iterable[str] | None = None) -> Series:
        """Same rows in the same series, other columns; size facts stay valid."""
        facts = self.known or self._cache.get("profile")
        return replace(
            self, df=df, values=tuple(values or self.values), known=facts, _cache={}
        )

    def columns(self, wanted: Iterable[str] | None) -> list[str]:
        """The chosen value columns, or all of them; unknown names are an error."""
        chosen = list(wanted) if wanted is not None else list(self.values)
        unknown = [c for c in chosen if c not in self.df.columns]
        if unknown:
            raise ValueError(f"Columns not found: {unknown}")
        return chosen

    def attach(self, df: DataFrame, per_series: DataFrame, how: str = "left") -> DataFrame:
        """Join a one-row-per-series table back onto rows.

        The table has as many rows as there are series, which the profile counted: it is broadcast only
        below `BROADCAST_CELLS`. Above that it is an ordinary equi-join that adaptive execution may split.
        """
        return df.join(small_side(per_series, self.profile().series), list(self.keys), how)

    def transform_rows(
        self,
        plan: Callable[[DataFrame, "Frames"], DataFrame],  # noqa: F821
        before: int = 0,
        after: int = 0,
    ) -> DataFrame:
        """Run a row-window plan over every series, in blocks where a series is long.

        `before` / `after` say how many neighbouring rows the plan's frames may look at.
        """
        from tidewatch.plans.layout import arrange

        rows, frames = arrange(self, before, after)
        return frames.strip(plan(rows, frames))


def small_side(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast a counted table when rows times columns are few; otherwise leave the join to adaptive execution. Columns of
    arrays count as one cell per burst cut."""
    width = sum(256 if isinstance(f.dataType, T.ArrayType) else 1 for f in table.schema.fields)
    return F.broadcast(table) if rows * width <= BROADCAST_CELLS else table


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the numeric columns in schema order, without `exclude`."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def missing_as_null(column: Column | str, dtype: T.DataType | None = None) -> Column:
    """A DOUBLE in which NaN has become NULL, the only missing value used downstream."""
    c = F.col(column) if isinstance(column, str) else column
    c = c.cast("double")
    if dtype is not None and not isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c
    return F.when(~F.isnan(c), c)


def load_series(
    df: DataFrame,
    keys: Iterable[str] = (),
    ts: str = "timestamp",
    tie: str | None = None,
    values: Iterable[str] | None = None,
    block_rows: int = BLOCK_ROWS,
    known: Profile | None = None,
) -> Series:
    """Make a series of a frame: time becomes TIMESTAMP, measured columns DOUBLE with NULL for missing.

    Without `keys` the frame is one series; it gets the constant key column `series`.
    """
    if not tuple(keys):
        df, keys = df.withColumn("series", F.lit("all")), ("series",)
    keys = tuple(keys)
    absent = [c for c in [*keys, ts, *([tie] if tie else []), *(values or [])] if c not in df.columns]
    if absent:
        raise ValueError(f"Columns not found: {absent}")
    if values is None:
        values = numeric_columns(df, exclude=[*keys, ts, *([tie] if tie else [])])
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {v: missing_as_null(v, types[v]) for v in values}
    if not isinstance(types[ts], T.NumericType):
        changed[ts] = F.col(ts).cast("timestamp")
    return Series(df.withColumns(changed), keys, ts, tie, tuple(values), block_rows, known)
