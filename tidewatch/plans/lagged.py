"""Windows of consecutive rows as vectors, without storing them.

A window of `length` rows of d columns is a vector of length * d numbers, and neighbouring windows share all but d of them.
Rows are read in order, task by task, and the vectors exist for one batch only. The products of all pairs of entries, summed
over windows, come from lag products: those with the newest row are summed once per lag, and shifting both entries by one
row adds a product at the front and takes one off at the end, so a batch of m rows costs m * length * d^2.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.plans.layout import CORE, arrange
from tidewatch.plans.series import Series

#: Vectors that exist at once.
VECTORS = 4096


def lag_products(x: np.ndarray, first: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, products) of the windows that end at rows first, first + 1, ... of x: of every entry, and of every pair.

    Entries are (lag, column), lag 0 being the row that ends the window."""
    n, d = x.shape
    sums, products = np.zeros((length, d)), np.zeros((length, length, d, d))
    for b in range(length):
        own = x[first - b : n - b]
        sums[b] = own.sum(axis=0)
        products[0, b] = x[first:n].T @ own
    # Entries (a + 1, b + 1) run over the rows of (a, b), one row earlier.
    for a in range(length - 1):
        gone, come = x[n - 1 - a], x[first - 1 - a]
        for b in range(a, length - 1):
            products[a + 1, b + 1] = products[a, b] + np.outer(come, x[first - 1 - b]) - np.outer(gone, x[n - 1 - b])
    for a in range(length):
        for b in range(a):
            products[a, b] = products[b, a].T
    return sums.reshape(-1), products.transpose(0, 2, 1, 3).reshape(length * d, length * d)


def laid_out(series: Series, cells: list[Column], length: int, keep: list[str]) -> DataFrame:
    """Rows in order within each task: `_group` (changes with the series or its block), `_core`, the cells as `_x`, and `keep`."""
    values = F.array(*cells).alias("_x")
    # Columns of the layout would clash with those kept; only what is needed goes on.
    wanted = list(dict.fromkeys([*series.identity, *keep]))
    rows, frames = arrange(series.with_df(series.df.select(*wanted, values)), before=length - 1)
    core = F.col(CORE) if frames.blocked else F.lit(True)
    group = F.xxhash64(*frames.group).alias("_group")
    rows = rows.withColumn("_here", core).repartition(*frames.group).sortWithinPartitions(*frames.group, *frames.order)
    return rows.select(group, F.col("_here").alias("_core"), "_x", *keep)


def windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, int, np.ndarray, pa.RecordBatch, int]]:
    """(rows, first, core, batch, at) for stretches of one series: windows end at rows first, first + 1, ..., whose batch
    rows start at `at`; `core` tells which of these windows count. Rows of earlier batches are carried on."""
    carried, group = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch.column("_group").to_numpy()
        column = batch.column("_x")
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        core = batch.column("_core").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            own = x[low:high]
            before = carried if carried is not None and group == groups[low] else own[:0]
            rows = np.concatenate([before, own])
            first = max(length - 1, len(before))
            if first < len(rows):
                at = low + first - len(before)
                yield rows, first, core[at:high], batch, at
            carried, group = rows[len(rows) - min(len(rows), length - 1) :], groups[low]


def covariance(laid: DataFrame, width: int, length: int) -> tuple[int, np.ndarray]:
    """(windows, sample covariance of their entries, oldest row first). One row of width x width numbers per task is summed
    in a tree of `fan` each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(width), np.zeros((width, width))
        for rows, first, core, _, _ in windows(batches, length):
            # Windows that count are one stretch: halo rows stand before the rows of a block.
            counted = np.flatnonzero(core)
            if len(counted):
                start, stop = first + int(counted[0]), first + int(counted[-1]) + 1
                s, p = lag_products(rows[:stop], start, length)
                n, sums, products = n + stop - start, sums + s, products + p
        yield packed(n, sums, products)

    def packed(n: int, sums: np.ndarray, products: np.ndarray) -> pa.RecordBatch:
        data = np.concatenate([[float(n)], sums, products.ravel()]).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([data] if n else [], pa.binary())], names=["part"])

    def added(table: pa.Table) -> pa.Table:
        return pa.table({"part": pa.array([sum(np.frombuffer(p) for p in table["part"].to_pylist()).tobytes()], pa.binary())})

    parts = laid.mapInArrow(run, "part binary")
    fan = max(2, (64 << 20) // (8 * width * width))
    group = F.pmod(F.xxhash64("part"), F.lit(fan))
    found = parts.groupBy(group.alias("_g")).applyInArrow(added, "part binary").collect()
    if not found:
        return 0, np.zeros((width, width))
    total = sum(np.frombuffer(r["part"]) for r in found)
    n, mean = int(total[0]), total[1 : width + 1] / total[0]
    spread = (total[width + 1 :].reshape(width, width) - n * np.outer(mean, mean)) / max(n - 1, 1)
    d = width // length
    oldest_first = np.arange(width).reshape(length, d)[::-1].ravel()
    return n, spread[np.ix_(oldest_first, oldest_first)]


def per_window(
    laid: DataFrame, length: int, keep: list[str], fn: Callable[[np.ndarray], pa.Array], name: str, kind: str
) -> DataFrame:
    """`keep` and `name` = fn(vectors), for every full window, named by its last row; vectors have the oldest row first."""
    schema = ", ".join([*[f"`{c}` {t}" for c, t in laid.select(*keep).dtypes], f"`{name}` {kind}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first, core, batch, at in windows(batches, length):
            d = rows.shape[1]
            view = np.lib.stride_tricks.sliding_window_view(rows[first - length + 1 :], length, axis=0)
            for low in range(0, len(core), VECTORS):
                counted = pa.array(core[low : low + VECTORS])
                vectors = view[low : low + VECTORS].transpose(0, 2, 1).reshape(-1, length * d)
                part = batch.slice(at + low, len(vectors))
                cells = [*(part.column(c).filter(counted) for c in keep), fn(vectors).filter(counted)]
                yield pa.RecordBatch.from_arrays(cells, names=[*keep, name])

    return laid.mapInArrow(run, schema)
