"""Small frames and their pandas twins."""

from __future__ import annotations

import numpy as np
import pandas as pd

from tidewatch import load_series

SCHEMA = "key string, ts timestamp, id bigint, x double, y double"


def frame(n: int = 200, keys=("a", "b"), gaps: float = 0.0, seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    parts = []
    for k in keys:
        t = pd.Timestamp("2024-03-01") + pd.to_timedelta(np.sort(rng.integers(0, 5 * n, n)), unit="s")
        x, y = rng.normal(10, 3, n).round(3), rng.normal(0, 1, n).round(3)
        x[rng.random(n) < gaps] = np.nan
        parts.append(pd.DataFrame({"key": k, "ts": t, "id": np.arange(n), "x": x, "y": y}))
    return pd.concat(parts, ignore_index=True)


def series(spark, pdf: pd.DataFrame, block_rows: int = 1_000_000, values=("x", "y")):
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=3), SCHEMA)
    return load_series(df, ["key"], "ts", "id", list(values), block_rows)


def collected(df) -> pd.DataFrame:
    return df.toPandas().sort_values(["key", "id"]).reset_index(drop=True)


def close(a, b, tol: float = 1e-8) -> None:
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    assert a.shape == b.shape
    assert (np.isnan(a) == np.isnan(b)).all()
    np.testing.assert_allclose(np.nan_to_num(a), np.nan_to_num(b), rtol=1e-7, atol=tol)
