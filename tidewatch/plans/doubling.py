"""Sliding-window summaries built by merging neighbours instead of re-reading every frame.

A sliding frame in Spark is evaluated from scratch for every row: n * w aggregate updates. A summary that
can be merged needs far less. The summary of the newest 2p rows is the merge of the one of the newest p rows
here and the one p rows back, so powers of two come from one `lag` each, and a window of any size w is the
merge of the powers in its binary form (60 = 32 + 16 + 8 + 4, laid end to end). That is O(log w) per row,
row-local arithmetic between `lag`s over one and the same sorted partition, and windows of thousands of rows
stay affordable. Merging uses the pairwise update formulas for central moments, which keep their accuracy
where differences of running sums would cancel.

Every segment has a fixed size, so a summary with a missing value in it is NULL and NULL spreads by itself:
the result is there exactly when the window holds w known values.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidewatch.plans.layout import Frames

# Expressions here are SQL text: a plan has hundreds of them, and text reaches the JVM in one call each.


def _known(value: str, columns: list[str]) -> str:
    test = " AND ".join(f"`{c}` IS NOT NULL" for c in columns)
    return f"CASE WHEN {test} THEN {value} END"


class Moments:
    """Mean and central moment sums of one column up to order 4, as far as `order` asks."""

    def __init__(self, column: str, order: int = 4):
        self.name, self.column, self.order = f"mo_{column}", column, order
        self.fields = ("m", "s2", "s3", "s4")[:order]

    def single(self) -> dict[str, str]:
        return {f: f"`{self.column}`" if f == "m" else _known("0D", [self.column]) for f in self.fields}

    def merge(self, new: dict, old: dict, a: int, b: int) -> dict[str, str]:
        n = a + b
        d = f"({old['m']} - {new['m']})"
        out = {"m": f"{new['m']} + {d} * {_num(b / n)}"}
        if self.order >= 2:
            out["s2"] = f"{new['s2']} + {old['s2']} + {d} * {d} * {_num(a * b / n)}"
        if self.order >= 3:
            cross = f"{old['s2']} * {_num(3 * a / n)} - {new['s2']} * {_num(3 * b / n)}"
            cube = _num(a * b * (a - b) / n**2)
            out["s3"] = f"{new['s3']} + {old['s3']} + {d} * ({d} * {d} * {cube} + {cross})"
        if self.order >= 4:
            spread = f"{old['s2']} * {_num(6 * a * a / n**2)} + {new['s2']} * {_num(6 * b * b / n**2)}"
            tilt = f"{old['s3']} * {_num(4 * a / n)} - {new['s3']} * {_num(4 * b / n)}"
            lead = _num(a * b * (a * a - a * b + b * b) / n**3)
            inner = f"{d} * ({d} * {d} * {lead} + {spread}) + {tilt}"
            out["s4"] = f"{new['s4']} + {old['s4']} + {d} * ({inner})"
        return out


class CoMoments:
    """Means, squared spreads and the cross product sum of two columns."""

    fields = ("mx", "my", "xx", "yy", "xy")

    def __init__(self, x: str, y: str):
        self.name, self.x, self.y = f"co_{x}_{y}", x, y

    def single(self) -> dict[str, str]:
        both = [self.x, self.y]
        out = {"mx": _known(f"`{self.x}`", both), "my": _known(f"`{self.y}`", both)}
        return out | {f: _known("0D", both) for f in ("xx", "yy", "xy")}

    def merge(self, new: dict, old: dict, a: int, b: int) -> dict[str, str]:
        n = a + b
        dx, dy = f"({old['mx']} - {new['mx']})", f"({old['my']} - {new['my']})"
        weight = _num(a * b / n)
        return {
            "mx": f"{new['mx']} + {dx} * {_num(b / n)}",
            "my": f"{new['my']} + {dy} * {_num(b / n)}",
            "xx": f"{new['xx']} + {old['xx']} + {dx} * {dx} * {weight}",
            "yy": f"{new['yy']} + {old['yy']} + {dy} * {dy} * {weight}",
            "xy": f"{new['xy']} + {old['xy']} + {dx} * {dy} * {weight}",
        }


class Extremes:
    """Smallest and largest value."""

    fields = ("lo", "hi")

    def __init__(self, column: str):
        self.name, self.column = f"ex_{column}", column

    def single(self) -> dict[str, str]:
        return {"lo": f"`{self.column}`", "hi": f"`{self.column}`"}

    def merge(self, new: dict, old: dict, a: int, b: int) -> dict[str, str]:
        both = f"{new['lo']} IS NOT NULL AND {old['lo']} IS NOT NULL"
        return {
            "lo": f"CASE WHEN {both} THEN least({new['lo']}, {old['lo']}) END",
            "hi": f"CASE WHEN {both} THEN greatest({new['hi']}, {old['hi']}) END",
        }


def _num(x: float) -> str:
    return f"{float(x)!r}D"


def summary(state, window: int, field: str) -> str:
    """A field of a finished window summary, as SQL text."""
    return f"`{_cell(state, f'w{window}', field)}`"


def _cell(state, stage: str, field: str) -> str:
    return f"_{state.name}_{stage}_{field}"


def _row(state, stage: str) -> dict[str, str]:
    return {f: f"`{_cell(state, stage, f)}`" for f in state.fields}


def _bits(window: int) -> list[int]:
    return [1 << i for i in range(window.bit_length() - 1, -1, -1) if window >> i & 1]


def extended(df: DataFrame, cells: dict[str, str]) -> DataFrame:
    """Add columns given as SQL text."""
    return df.selectExpr("*", *[f"{sql} AS `{name}`" for name, sql in cells.items()])


def add_summaries(df: DataFrame, frames: Frames, states: list, windows: Iterable[int]) -> DataFrame:
    """Adds the columns that `summary` reads, for every state and window size."""
    sizes = sorted(set(windows))
    over = frames.sql()
    keep = [f"`{c}`" for c in df.columns]

    def shifted(stage: str, back: int) -> dict[str, str]:
        return {
            _cell(s, f"{stage}_{back}", f): f"lag(`{_cell(s, stage, f)}`, {back}) OVER {over}"
            for s in states
            for f in s.fields
        }

    def merged(target: str, new: str, old: str, a: int, b: int) -> dict[str, str]:
        return {
            _cell(s, target, f): sql
            for s in states
            for f, sql in s.merge(_row(s, new), _row(s, old), a, b).items()
        }

    df = extended(df, {_cell(s, "p1", f): sql for s in states for f, sql in s.single().items()})
    p = 1
    while 2 * p <= sizes[-1]:
        df = extended(df, shifted(f"p{p}", p))
        df = extended(df, merged(f"p{2 * p}", f"p{p}", f"p{p}_{p}", p, p))
        p *= 2

    plans = {w: _bits(w) for w in sizes}
    lags: dict[str, str] = {}
    for bits in plans.values():
        done = bits[0]
        for b in bits[1:]:
            # A power shifted by its own size is there already, from the doubling.
            if done != b:
                lags |= shifted(f"p{b}", done)
            done += b
    if lags:
        df = extended(df, lags)
    reached = {w: (bits[0], f"p{bits[0]}") for w, bits in plans.items()}
    for step in range(1, max(len(b) for b in plans.values())):
        cells: dict[str, str] = {}
        for w, bits in plans.items():
            if step < len(bits):
                done, stage = reached[w]
                b = bits[step]
                cells |= merged(f"t{w}_{step}", stage, f"p{b}_{done}", done, b)
                reached[w] = (done + b, f"t{w}_{step}")
        df = extended(df, cells)
    return df.selectExpr(
        *keep,
        *[
            f"`{_cell(s, reached[w][1], f)}` AS `{_cell(s, f'w{w}', f)}`"
            for w in sizes
            for s in states
            for f in s.fields
        ],
    )
