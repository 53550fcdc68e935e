"""Labelled anomalies put into any series, to back-test detectors against known truth: I1-I6.

An anomaly covers a range of row positions given as shares of the series' length and scales with the
series' own deviation. The truth column is written by the same predicate that changes the value. The
chance in intermittent faults hashes the row's identity, so it does not move with partitioning.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.hashing import hash_uniform, row_key
from tidewatch.plans.layout import arrange
from tidewatch.plans.series import Series
from tidewatch.session import pinned

KINDS = ("spike", "drift", "intermittent")


@dataclass(frozen=True)
class Spike:
    """A parabolic bump around a position."""

    sensor: str
    position_ratio: float = 0.5
    duration_ratio: float = 0.002
    amplitude_factor: float = 3.0

    def reaches(self, at: Column, n: Column) -> Column:
        position, duration = self._place(n)
        half = F.floor(duration / 2)
        return (at >= F.greatest(position - half, F.lit(0))) & (at < F.least(n, position + half))

    def _place(self, n: Column) -> tuple[Column, Column]:
        position = F.floor(n * F.lit(self.position_ratio))
        return position, F.greatest(F.floor(n * F.lit(self.duration_ratio)), F.lit(1))

    def hits(self, at: Column, n: Column, draw) -> Column:
        position, duration = self._place(n)
        return self.reaches(at, n) & (F.abs(at - position) <= duration / 2)

    def change(self, at: Column, n: Column, draw) -> Column:
        position, duration = self._place(n)
        distance = F.abs(at - position) / (duration / 2)
        return F.lit(self.amplitude_factor) * (F.lit(1.0) - distance * distance)


@dataclass(frozen=True)
class Drift:
    """An offset growing from 0 over a range."""

    sensor: str
    start_ratio: float = 0.6
    end_ratio: float = 0.8
    drift_factor: float = 2.0

    def __post_init__(self):
        if self.end_ratio <= self.start_ratio:
            raise ValueError("end_ratio must be greater than start_ratio")

    def _range(self, n: Column) -> tuple[Column, Column]:
        return F.floor(n * F.lit(self.start_ratio)), F.floor(n * F.lit(self.end_ratio))

    def hits(self, at: Column, n: Column, draw) -> Column:
        start, end = self._range(n)
        return (at >= start) & (at < end)

    def change(self, at: Column, n: Column, draw) -> Column:
        start, end = self._range(n)
        return F.lit(self.drift_factor) * F.try_divide((at - start).cast("double"), end - start)


@dataclass(frozen=True)
class Intermittent:
    """Random readings of a range thrown off by a random amount of either sign."""

    sensor: str
    start_ratio: float = 0.3
    end_ratio: float = 0.4
    frequency: float = 0.2
    amplitude_factor: float = 2.0

    def hits(self, at: Column, n: Column, draw) -> Column:
        start, end = F.floor(n * F.lit(self.start_ratio)), F.floor(n * F.lit(self.end_ratio))
        return (at >= start) & (at < end) & (draw("hit") < self.frequency)

    def change(self, at: Column, n: Column, draw) -> Column:
        sign = F.when(draw("sign") > 0.5, F.lit(1.0)).otherwise(F.lit(-1.0))
        return sign * F.lit(self.amplitude_factor) * draw("size")


Anomaly = Spike | Drift | Intermittent
_BY_KIND = {"spike": Spike, "drift": Drift, "intermittent": Intermittent}


def truth_name(sensor: str) -> str:
    return f"{sensor}_anomaly"


def _rounds(plan: list[Anomaly]) -> list[dict[str, tuple[int, Anomaly]]]:
    """The r-th anomaly of every sensor, round by round, each with its place in the plan."""
    rounds: list[dict[str, tuple[int, Anomaly]]] = []
    depth: dict[str, int] = {}
    for i, a in enumerate(plan):
        r = depth.get(a.sensor, 0)
        depth[a.sensor] = r + 1
        if r == len(rounds):
            rounds.append({})
        rounds[r][a.sensor] = (i, a)
    return rounds


def inject(series: Series, anomalies: Iterable[Anomaly], seed: int = 42) -> DataFrame:
    """Apply anomalies in order and add a BOOLEAN {sensor}_anomaly per touched sensor.

    Positions are laid out once. Anomalies of different sensors share a round: one aggregate of lengths and
    deviations, joined back, then plain expressions. A second anomaly on a sensor scales with the deviation
    left by the first, so it takes another round over a pinned per-series table.
    """
    plan = list(anomalies)
    sensors = series.columns(dict.fromkeys(a.sensor for a in plan))
    rows, frames = arrange(series)
    rows = frames.strip(rows.withColumn("_at", frames.position() - 1))
    rows = rows.withColumns({truth_name(s): F.lit(False) for s in sensors})
    at, n = F.col("_at"), F.col("_n")
    key = row_key(*series.keys, series.tie or series.ts)

    rounds = _rounds(plan)
    for placed in rounds:
        cells = [F.stddev_pop(s).alias(f"_std_{s}") for s in placed]
        table = rows.groupBy(*series.keys).agg(F.count(F.lit(1)).alias("_n"), *cells)
        if len(rounds) > 1:
            table = pinned(table)
        changed = {}
        for s, (i, a) in placed.items():
            def draw(name: str, i: int = i) -> Column:
                return hash_uniform(key, f"{seed}:{i}:{name}")

            hit = a.hits(at, n, draw)
            moved = F.when(hit, a.change(at, n, draw) * F.col(f"_std_{s}")).otherwise(F.lit(0.0))
            changed[s] = F.col(s) + moved
            changed[truth_name(s)] = F.col(truth_name(s)) | hit
        rows = series.attach(rows, table).withColumns(changed).drop("_n", *[f"_std_{s}" for s in placed])
    return rows.select(*series.df.columns, *[truth_name(s) for s in sensors])


def read_plan(text: str) -> list[Anomaly]:
    """Anomalies out of plan JSON: {"anomalies": [{"type": ..., "sensor": ..., parameters}]}."""
    plan = []
    for entry in json.loads(text).get("anomalies", []):
        entry = dict(entry)
        kind = entry.pop("type", None)
        if kind not in _BY_KIND:
            raise ValueError(f"Unknown anomaly type {kind!r}; choose from {list(KINDS)}")
        plan.append(_BY_KIND[kind](**entry))
    return plan


def apply_plan(series: Series, text: str, seed: int = 42) -> DataFrame:
    return inject(series, read_plan(text), seed)


def _random_range(rng: random.Random) -> dict[str, float]:
    start = rng.uniform(0.2, 0.7)
    return {"start_ratio": start, "end_ratio": start + rng.uniform(0.1, 0.3)}


def random_plan(sensors: Iterable[str], count: int = 3, seed: int = 42) -> list[Anomaly]:
    """`count` anomalies per sensor at random places, else with their defaults; one seed, one plan."""
    rng = random.Random(seed)
    plan: list[Anomaly] = []
    for sensor in sensors:
        for kind in rng.choices(KINDS, k=count):
            place = {"position_ratio": rng.uniform(0.1, 0.9)} if kind == "spike" else _random_range(rng)
            plan.append(_BY_KIND[kind](sensor, **place))
    return plan
