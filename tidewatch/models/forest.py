"""Isolation forest as Spark jobs: D6.

Training needs a few hundred rows per tree whatever the table holds. Rows are drawn by hash: one threshold
filter over the table, then one per tree over what is left, so a draw does not depend on partitioning. Each
tree is built in its own group of at most `sample` rows. Trees are a few hundred nodes each and go to every
task; scoring runs over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.hashing import hash_uniform
from tidewatch.models.base import FittedModel, checked_features, standardised
from tidewatch.plans.ordered import exact_quantile

TREE_SCHEMA = (
    "tree int, feature array<int>, cut array<double>, left array<int>, right array<int>, rows array<int>"
)


def expected_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    safe = np.where(big, n, 3.0)
    return np.where(big, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe, out)


def grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> dict[str, list]:
    """One isolation tree as parallel node lists; leaves have feature -1."""
    nodes = {"feature": [], "cut": [], "left": [], "right": [], "rows": []}
    pending = [(np.arange(len(x)), 0, None, "left")]
    while pending:
        rows, depth, parent, side = pending.pop()
        here = len(nodes["feature"])
        if parent is not None:
            nodes[side][parent] = here
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        open_columns = np.flatnonzero(high > low)
        for key, value in (("feature", -1), ("cut", 0.0), ("left", -1), ("right", -1), ("rows", len(rows))):
            nodes[key].append(value)
        if depth >= limit or len(rows) < 2 or not len(open_columns):
            continue
        f = int(rng.choice(open_columns))
        cut = float(rng.uniform(low[f], high[f]))
        nodes["feature"][here], nodes["cut"][here] = f, cut
        goes_left = x[rows, f] <= cut
        pending.append((rows[goes_left], depth + 1, here, "left"))
        pending.append((rows[~goes_left], depth + 1, here, "right"))
    return nodes


def walkable(tree: dict) -> dict:
    """A tree for `path_lengths`: leaves lead to themselves, and every node has its path length."""
    feature, n = np.asarray(tree["feature"]), len(tree["feature"])
    leaf, own, depth, steps = feature < 0, np.arange(n), np.zeros(n), 0
    left, right = np.where(leaf, own, tree["left"]), np.where(leaf, own, tree["right"])
    level = own[:1]
    while len(level := level[~leaf[level]]):
        steps += 1
        level = np.concatenate([left[level], right[level]])
        depth[level] = steps
    children = np.stack([right, left], axis=1).ravel()
    return {"feature": np.maximum(feature, 0), "cut": np.asarray(tree["cut"]), "children": children, "steps": steps,
            "length": depth + expected_depth(tree["rows"])}


def path_lengths(x: np.ndarray, trees: list[dict]) -> np.ndarray:
    """Mean path length of every row over all trees."""
    total = np.zeros(len(x))
    cells, start = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    for t in trees:
        t = t if "children" in t else walkable(t)
        at = np.zeros(len(x), dtype=int)
        for _ in range(t["steps"]):
            at = t["children"][2 * at + (cells[start + t["feature"][at]] <= t["cut"][at])]
        total += t["length"][at]
    return total / len(trees)


class IsolationForest(FittedModel):
    algorithm = "isolation_forest"
    size_name = "trees"
    trees: list[dict]

    def scored(self, df: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
        return df.withColumn(f"score_{self.name}", self._score(df))

    def _score(self, df: DataFrame) -> Column:
        trees = df.sparkSession.sparkContext.broadcast(self.trees)
        scale = float(expected_depth(self.settings["sample"]))

        @F.pandas_udf("double")
        def isolation(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            ready = [walkable(t) for t in trees.value]
            for arrays in batches:
                if len(arrays) == 0:
                    yield pd.Series([], dtype=float)
                    continue
                yield pd.Series(2.0 ** (-path_lengths(np.stack(arrays.to_numpy()), ready) / scale))

        return isolation(self.array(df))

    def write_payload(self, path: str, spark) -> None:
        rows = [(i, *[t[k].tolist() for k in ("feature", "cut", "left", "right", "rows")]) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, TREE_SCHEMA).write.mode("overwrite").parquet(f"{path}/trees")

    def read_payload(self, path: str, spark) -> None:
        self.trees = _arrays(spark.read.parquet(f"{path}/trees"))


def _arrays(table: DataFrame) -> list[dict]:
    """Trees to the driver: one row per tree, each bounded by twice its sample."""
    rows = sorted(table.collect(), key=lambda r: r["tree"])
    return [{k: np.asarray(r[k]) for k in ("feature", "cut", "left", "right", "rows")} for r in rows]


def _drawn(df: DataFrame, key: Column, x: Column, trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, x): about `sample` rows for every tree, never more."""
    n = max(df.count(), 1)
    first = min(1.0, 2.0 * trees * sample / n)
    pool = df.select(key.alias("_key"), x.alias("x")).filter(hash_uniform("_key", f"{seed}:pool") < first)
    share = min(1.0, 1.5 * sample / (n * first))
    each = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    each = each.withColumn("_u", hash_uniform(F.concat_ws("#", "_key", "tree"), seed)).filter(F.col("_u") < share)
    place = F.row_number().over(Window.partitionBy("tree").orderBy("_u", "_key"))
    return each.withColumn("_place", place).filter(F.col("_place") <= sample).select("tree", "x")


def grow_forest(
    df: DataFrame, features: Iterable[str], key: Column, trees: int = 100, sample: int = 256, seed: int = 42,
    name: str = "isolation_forest",
) -> IsolationForest:
    """A forest that scores, without a threshold yet. `key` is a text that names each row; the draw hashes it."""
    cols = checked_features(df, features)
    model = IsolationForest(name, cols, standardised(df, cols))
    model.settings = {"trees": trees, "sample": sample, "seed": seed}

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        x = np.stack(group["x"].to_numpy())
        x = x[np.lexsort(x.T)]
        nodes = grow(x, np.random.default_rng([seed, tree]), int(np.ceil(np.log2(max(sample, 2)))))
        return pd.DataFrame({"tree": [tree], **{k: [v] for k, v in nodes.items()}})

    drawn = _drawn(df, key, model.array(df), trees, sample, seed)
    model.trees = _arrays(drawn.groupBy("tree").applyInPandas(build, TREE_SCHEMA))
    if not model.trees:
        raise ValueError("No rows to train on")
    return model


def with_contamination(forest: IsolationForest, scores: DataFrame, contamination: float = 0.05) -> IsolationForest:
    """The forest with the exact (1 - contamination) quantile of its training scores as threshold; trees are shared."""
    score = f"score_{forest.name}"
    cut = exact_quantile(scores.select(score), score, 1.0 - contamination).first()[0]
    settings = {k: forest.settings[k] for k in ("trees", "sample")} | {"contamination": contamination, "seed": forest.settings["seed"]}
    model = replace(forest, threshold=cut, settings=settings)
    model.trees = forest.trees
    return model


def fit_isolation_forest(
    df: DataFrame,
    features: Iterable[str],
    key: Column,
    trees: int = 100,
    sample: int = 256,
    contamination: float = 0.05,
    seed: int = 42,
    name: str = "isolation_forest",
) -> IsolationForest:
    """`key` is a text that names each row; the draw hashes it.

    The threshold is the exact (1 - contamination) quantile of the training scores.
    """
    forest = grow_forest(df, features, key, trees, sample, seed, name)
    return with_contamination(forest, forest.scored(df.select(*forest.features)), contamination)
