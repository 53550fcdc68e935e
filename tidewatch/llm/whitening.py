"""Whitening of embeddings by the singular values of their centred rows.

The covariance is never formed. Every partition keeps the triangular factor of the centred rows it has seen (QR by blocks);
factors of neighbouring partitions are stacked and factored again until one is left. Its singular values and right singular
vectors (`bidiagonal`: Householder reflections, dqds, twisted factorisations) are those of all centred rows, so components
keep an accuracy that squaring would halve.

Entries enter as whole numbers x = floor(scale * c) + offset: their sums are exact, whatever the order of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewatch.llm.bidiagonal import EPS, ZERO, singular_pairs
from tidewatch.session import scratch_path

SCALE, OFFSET = 1024, 100_000
#: Entries of this size or more have no exact whole number and are no part of the table.
MOST = 2.0**43
#: Sums are kept in two parts of this many bits, so that none overflows.
HALF_BITS = 32
#: Bytes of factors that are stacked at once.
STACK_BYTES = 64_000_000


@dataclass(frozen=True)
class Whitening:
    """What a fit leaves: exact sums of n rows, eigenvalues of their covariance (largest first; of the wanted components),
    unit vectors as columns, and the trace."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows less their mean; whole parts are subtracted exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(float) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One column per component, NaN where the component has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            factor = np.where(self.eigenvalues > 0, 1 / np.sqrt(self.eigenvalues), np.nan)
        return (self.centred(x) @ self.vectors) * factor

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exact; None beyond 64 bits."""
        rough = ((self.n * self.centred(x)) ** 2).sum(axis=1)
        # Differences are taken modulo 2^64, which is exact wherever the sum of their squares fits.
        sums = np.array([s % 2**64 for s in self.sums], np.uint64)
        with np.errstate(over="ignore"):
            d = (x.view(np.uint64) * np.uint64(self.n) - sums).view(np.int64)
            out: list[int | None] = (d * d).sum(axis=1).tolist()
        for i in np.flatnonzero(~(rough < 2.0**62)).tolist():
            exact = sum((self.n * v - s) ** 2 for v, s in zip(x[i].tolist(), self.sums, strict=True))
            out[i] = exact if exact < 2**63 else None
        return out


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has no null and only finite entries of less than MOST; the vector as doubles."""
    kind = dict(df.dtypes)[vector]
    rows = df.withColumn(vector, F.col(vector).cast("array<double>")) if kind != "array<double>" else df
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < MOST))
    return rows.where(F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False)))


def _matrix(column: pa.Array) -> np.ndarray:
    """The whole numbers of a batch of vectors of one length."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.floor(SCALE * values).astype(np.int64) + OFFSET


def _sums(rows: DataFrame, vector: str) -> tuple[int, list[int]]:
    """(rows, exact sums) of the vectors of the length that most of them have, the longest of equals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            sizes = np.diff(column.offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                x = _matrix(column.filter(pa.array(sizes == d)))
                own = held.setdefault(d, [0, np.zeros(d, np.int64), np.zeros(d, np.int64)])
                own[0] += len(x)
                own[1] += (x >> HALF_BITS).sum(axis=0)
                own[2] += (x & (2**HALF_BITS - 1)).sum(axis=0)
        cells = [list(held), *([v[i] for v in held.values()] for i in range(3))]
        arrays = [pa.array(c, t) for c, t in zip(cells, (pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["d", "n", "high", "low"])

    parts = rows.select(vector).mapInArrow(run, "d bigint, n bigint, high array<bigint>, low array<bigint>")
    kept = scratch_path(rows.sparkSession, "whitening-sums")
    parts.write.parquet(kept)
    parts = rows.sparkSession.read.parquet(kept)
    most = parts.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if most is None or not most["d"]:
        return 0, []
    own = parts.where(F.col("d") == most["d"]).select(F.posexplode(F.arrays_zip("high", "low")))
    total = own.groupBy("pos").agg(F.sum("col.high").alias("high"), F.sum("col.low").alias("low")).orderBy("pos").collect()
    return most["n"], [(r["high"] << HALF_BITS) + r["low"] for r in total]


def _factor(rows: DataFrame, vector: str, centre: Whitening) -> np.ndarray:
    """The triangular factor of all centred rows: one per partition, then of neighbours until a handful is left."""
    spark, d = rows.sparkSession, len(centre.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            if batch.num_rows:
                r = np.linalg.qr(np.vstack([r, centre.centred(_matrix(batch.column(0)))]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()] if len(r) else [], pa.binary())], names=["r"])

    def stack(table: pa.Table) -> pa.Table:
        return pa.table({"r": pa.array([np.linalg.qr(_stacked(table["r"].to_pylist(), d), mode="r").tobytes()], pa.binary())})

    def stored(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "whitening-factors")
        df.write.parquet(path)
        return spark.read.parquet(path)

    factors = stored(rows.select(vector).mapInArrow(run, "r binary"))
    fan = max(2, STACK_BYTES // (8 * d * d))
    while (left := factors.count()) > fan:
        # Factors are dealt at random into groups of about `fan` each.
        group = F.pmod(F.xxhash64("r"), F.lit(-(-left // fan)))
        factors = stored(factors.groupBy(group.alias("part")).applyInArrow(stack, "r binary"))
    return np.linalg.qr(_stacked([f["r"] for f in factors.collect()], d), mode="r")


def _stacked(factors: list[bytes], d: int) -> np.ndarray:
    return np.vstack([np.zeros((0, d)), *(np.frombuffer(f, float).reshape(-1, d) for f in factors)])


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int | None = None) -> Whitening | None:
    """Fits the components (all by default) on every usable vector of `df`; None when there is none.

    Vectors that are null or hold a null, non-finite or enormous (2^43 and more) entry take no part, nor do those of another
    length than most have. Repeated rows count as often as they stand there. A component whose singular value is within
    rounding of 0 has eigenvalue 0. The driver holds factors of d x d numbers, a bounded number of them, and no rows.
    """
    rows = usable(df, vector)
    n, sums = _sums(rows, vector)
    if not n:
        return None
    d = len(sums)
    wanted = d if components is None else min(components, d)
    centre = Whitening(n, tuple(sums), np.zeros(0), np.zeros((d, 0)), 0.0)
    r = _factor(rows.where(F.size(vector) == d), vector, centre)
    square = np.zeros((d, d))
    square[: len(r)] = r
    values, vectors = singular_pairs(square, wanted)
    values = np.where(values <= (ZERO * d * EPS) ** 2 * values[0], 0.0, values)
    # Either sign will do: the entry of largest size is positive.
    peaks = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[peaks, np.arange(wanted)] < 0, -1.0, 1.0)
    return Whitening(n, tuple(sums), values[:wanted] / n, vectors, float(values.sum() / n))


def identity_error(df: DataFrame, fitted: Whitening, vector: str = "embedding") -> float | None:
    """Largest absolute entry of the covariance (divisor n, centred) of the whitened rows less the identity, measured on all
    rows of the fit; None where no component has variance."""
    d, live = len(fitted.sums), fitted.eigenvalues > 0
    k = int(live.sum())
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = fitted.whitened(_matrix(batch.column(0)))[:, live]
                sums += w.sum(axis=0)
                products += w.T @ w
        cells = [*sums.tolist(), *products.ravel().tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), pa.array(cells)], names=["cell", "v"])

    rows = usable(df, vector).where(F.size(vector) == d).select(vector)
    cells = rows.mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).orderBy("cell").collect()
    v = np.array([c["v"] for c in cells]) / fitted.n
    covariance = v[k:].reshape(k, k) - np.outer(v[:k], v[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(df: DataFrame, fitted: Whitening | None, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector of `df` and component: `id`, component (from 1), deviation, whitened.

    deviation is the exact sum of (n * x - S)^2 over the dimensions, NULL beyond 64 bits; whitened is NULL where the component
    has no variance. Vectors of another length than the fit's, and those `fit_whitening` leaves out, give no rows; a null id
    stays; repeated rows each give rows; without a fit, or from an empty table, none come out; other columns are not read.
    """
    kind = dict(df.dtypes)[id]
    schema = f"`{id}` {kind}, component int, deviation bigint, whitened double"
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    d, k, arrow = len(fitted.sums), len(fitted.eigenvalues), to_arrow_type(df.schema[id].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1)) if batch.num_rows else np.zeros((0, d), np.int64)
            w = fitted.whitened(x).ravel()
            deviations = pa.array(fitted.deviations(x), pa.int64())
            each = pa.array(np.repeat(np.arange(len(x)), k))
            number = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)))
            cells = [batch.column(0).take(each).cast(arrow), number, deviations.take(each), pa.array(w, mask=np.isnan(w))]
            yield pa.RecordBatch.from_arrays(cells, names=[id, "component", "deviation", "whitened"])

    rows = usable(df.select(F.col(id), F.col(vector)), vector)
    return rows.where(F.size(vector) == d).mapInArrow(run, schema)


def whitening_report(df: DataFrame, components: int = 8, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Fit on all of `df`, apply to all of it: `id`, component, n, deviation, whitened, explained (share of the trace), and
    identity_error, one value for all rows."""
    fitted = fit_whitening(df, vector, components)
    rows = whiten(df, fitted, id, vector)
    shares, error, n = [], None, 0
    if fitted is not None:
        n, error = fitted.n, identity_error(df, fitted, vector)
        shares = [float(e / fitted.trace) if fitted.trace > 0 else None for e in fitted.eigenvalues]
    explained = F.element_at(F.array(*(F.lit(s).cast("double") for s in shares)), F.col("component")) if shares else F.lit(None)
    return rows.select(
        id,
        "component",
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        explained.cast("double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
