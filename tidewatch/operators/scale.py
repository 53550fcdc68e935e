"""Fitting and applying column scalers: F4-F6.

A fitted scaler is a small table (column, centre, spread): one row per column, so applying it means writing
its numbers into the projection. Spark ML's scalers are not used: they divide by the sample deviation and
send flat columns to the middle of the range.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.plans.series import numeric_columns

METHODS = ("standard", "minmax")


@dataclass(frozen=True)
class Scaler:
    """scaled = (x - centre) / spread, per column."""

    method: str
    parameters: dict[str, tuple[float, float]]

    @property
    def columns(self) -> list[str]:
        return list(self.parameters)

    def transform(self, df: DataFrame) -> DataFrame:
        cells = []
        for c in df.columns:
            if c in self.parameters:
                centre, spread = self.parameters[c]
                cells.append(f"(`{c}` - {float(centre)!r}D) / {float(spread)!r}D AS `{c}`")
            else:
                cells.append(f"`{c}`")
        return df.selectExpr(*cells)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(self.method, c, i, a, b) for i, (c, (a, b)) in enumerate(self.parameters.items())]
        return spark.createDataFrame(
            rows, "method string, column string, at int, centre double, spread double"
        )

    @staticmethod
    def from_table(df: DataFrame) -> Scaler:
        rows = sorted(df.collect(), key=lambda r: r["at"])
        return Scaler(rows[0]["method"], {r["column"]: (r["centre"], r["spread"]) for r in rows})


def _centre_and_spread(method: str, c: str) -> tuple[str, str]:
    if method == "standard":
        return f"avg(`{c}`)", f"stddev_pop(`{c}`)"
    return f"min(`{c}`)", f"max(`{c}`) - min(`{c}`)"


def _checked(method: str) -> str:
    if method not in METHODS:
        raise ValueError(f"Unknown method {method!r}; choose from {list(METHODS)}")
    return method


def fit_scaler(df: DataFrame, columns: Iterable[str] | None = None, method: str = "standard") -> Scaler:
    """One aggregate over all columns; missing values are left out, flat columns get spread 1."""
    _checked(method)
    cols = list(columns) if columns is not None else numeric_columns(df)
    cells = []
    for i, c in enumerate(cols):
        centre, spread = _centre_and_spread(method, c)
        cells += [f"CAST({centre} AS DOUBLE) AS c{i}", f"CAST({spread} AS DOUBLE) AS s{i}"]
    row = df.selectExpr(*cells).first()
    return Scaler(
        method,
        {
            c: (row[f"c{i}"], row[f"s{i}"] or 1.0)
            for i, c in enumerate(cols)
            if row[f"c{i}"] is not None
        },
    )


def scale(df: DataFrame, columns: Iterable[str] | None = None, method: str = "standard") -> DataFrame:
    """Fit on the frame and apply to it."""
    return fit_scaler(df, columns, method).transform(df)


def scale_by_series(series, columns: Iterable[str] | None = None, method: str = "standard") -> DataFrame:
    """Each series scaled by its own parameters: a per-series table joined back, no driver round trip."""
    _checked(method)
    cols = series.columns(columns)
    cells = []
    for c in cols:
        centre, spread = _centre_and_spread(method, c)
        cells += [
            F.expr(centre).alias(f"_centre_{c}"),
            F.expr(f"coalesce(nullif({spread}, 0), 1D)").alias(f"_spread_{c}"),
        ]
    table = series.df.groupBy(*series.keys).agg(*cells)
    out = series.attach(series.df, table)
    scaled = {c: (F.col(c) - F.col(f"_centre_{c}")) / F.col(f"_spread_{c}") for c in cols}
    return out.withColumns(scaled).select(*series.df.columns)
