"""Spectra of series of any length, by a Fourier transform in steps that are spread over tasks.

A transform of length n1 * n2 is n2 transforms of length n1 (over the positions that agree modulo n2), a turn of every
result, and n1 transforms of length n2. The first step groups rows by blocks of residues, the second gathers blocks of
results, so a group holds about `piece` numbers, or one transform of about the root of the length where that is more. Small
groups come to a task in bundles of about `BUNDLE` numbers. What moves between the steps are packed arrays. A length without factors of like size is turned into a convolution with a chirp
(a power of two at least twice as long); the inverse transform of that runs backwards over the same groups and takes one
step more.

No group sees a whole spectrum: energies, centroid and entropy are sums over its blocks, as the total power is known from
the rows beforehand; the strongest frequencies are those of the strongest of every block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tidewatch.plans.series import small_side
from tidewatch.session import pinned

#: Numbers one group gathers.
PIECE = 1 << 20
#: Numbers of the groups that one call of Python works on.
BUNDLE = 1 << 19
_PLAN = "struct<m: bigint, n1: bigint, n2: bigint, chirp: boolean>"
_PARTIAL = (
    "struct<low: double, mid: double, high: double, centre: double, entropy: double, "
    "top: array<struct<magnitude: double, freq: double>>>"
)


def split(n: int, piece: int) -> tuple[int, int, int, bool]:
    """(length, n1, n2, chirp): the length itself where it has factors of at most `piece`, or the root, numbers; else that of
    the chirp."""
    n1 = next(f for f in range(isqrt(n), 0, -1) if n % f == 0)
    if n // n1 <= max(piece, 2 * isqrt(n)):
        return n, n1, n // n1, False
    bits = (2 * n - 1).bit_length()
    return 1 << bits, 1 << bits // 2, 1 << bits - bits // 2, True


def chirp(t: np.ndarray, n: int) -> np.ndarray:
    """exp(i pi t^2 / n); squares are taken modulo 2 n, in two halves, so they stay exact."""
    m, low = 2 * n, t & ((1 << 20) - 1)
    square = ((t >> 20) * ((t << 20) % m) + low * (t % m)) % m
    return np.exp(1j * np.pi * square / n)


def turned(rows: np.ndarray, columns: np.ndarray, m: int, sign: int) -> np.ndarray:
    """exp(sign 2 pi i r c / m) for all rows and columns."""
    return np.exp(sign * 2j * np.pi * ((rows[:, None] * columns[None, :]) % m) / m)


def partial_features(k: np.ndarray, power: np.ndarray, n: int, total: float, include_dc: bool, top: int) -> dict:
    """What a part of a spectrum adds to the features of all of it."""
    inside = k <= n // 2
    k, power = k[inside], power[inside]
    freq, highest = k / n, (n // 2) / n
    share = power / total if total > 0 else np.full_like(power, np.nan)
    able = np.flatnonzero(k > 0) if not include_dc and n > 1 else np.arange(len(k))
    magnitude = np.sqrt(power[able])
    best = able[np.lexsort((freq[able], magnitude))[::-1][:top]]
    return {
        "low": float(power[freq <= highest * 0.25].sum()),
        "mid": float(power[(freq > highest * 0.25) & (freq <= highest * 0.75)].sum()),
        "high": float(power[freq > highest * 0.75].sum()),
        "centre": float((freq * share).sum()),
        "entropy": float(-(share * np.log2(share + 1e-10)).sum()),
        "top": [{"magnitude": float(np.sqrt(power[i])), "freq": float(freq[i])} for i in best.tolist()],
    }


def long_spectra(rows: DataFrame, keys: list[str], values: list[str], include_dc: bool, top: int, piece: int = PIECE) -> DataFrame:
    """keys, rows, and a struct (low, mid, high, centre, entropy, top) per value column.

    `rows` has keys, `_t` (position from 0) and the value columns without gaps; it is read twice.
    """
    alternating = F.when(F.col("_t") % 2 == 0, 1.0).otherwise(-1.0)
    sums = [f(F.col(v)).alias(f"{name}_{v}") for v in values for name, f in (
        ("squares", lambda c: F.sum(c * c)), ("plain", F.sum), ("swing", lambda c: F.sum(c * alternating)))]
    facts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *sums)

    @F.pandas_udf(_PLAN)
    def planned(n: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([split(int(v), piece) for v in n], columns=["m", "n1", "n2", "chirp"])

    # Power of the one-sided spectrum: half of all, and the two bins that have no mirror image in full.
    def total(v: str) -> Column:
        even = F.when(F.col("_n") % 2 == 0, F.col(f"swing_{v}") ** 2).otherwise(0.0)
        return (F.col("_n") * F.col(f"squares_{v}") + F.col(f"plain_{v}") ** 2 + F.when(F.col("_n") > 1, even).otherwise(F.col(f"plain_{v}") ** 2)) / 2

    plan = facts.withColumn("_plan", planned("_n")).select(*keys, F.col("_n"), "_plan.*", F.array(*map(total, values)).alias("_totals"))
    plan = pinned(plan)
    n_series, numbers = plan.agg(F.count(F.lit(1)), F.coalesce(F.sum("m"), F.lit(0))).first()
    bundles = max(1, -(-numbers * (len(values) + 1) // BUNDLE))
    dealt = rows.join(small_side(plan, n_series), keys)
    width = F.greatest(F.lit(piece) / F.col("n1"), F.lit(1)).cast("bigint")
    dealt = dealt.withColumn("_block", F.floor((F.col("_t") % F.col("n2")) / width))
    fixed, group = ["_n", "m", "n1", "n2", "chirp"], [*keys, "_block"]
    key_schema = ", ".join(f"`{k}` {t}" for k, t in rows.select(*keys).dtypes)
    chunk = f"{key_schema}, _n bigint, m bigint, n1 bigint, n2 bigint, chirp boolean, _totals array<double>, _block bigint, at bigint, wide bigint, data binary"

    def groups(table: pa.Table) -> list[np.ndarray]:
        """Row numbers of every (keys, block) of a bundle."""
        code = np.zeros(table.num_rows, np.int64)
        for c in group:
            own = table[c].combine_chunks().dictionary_encode()
            place = own.indices.fill_null(len(own.dictionary)).to_numpy(zero_copy_only=False)
            code = np.unique(code * (len(own.dictionary) + 1) + place, return_inverse=True)[1]
        order = np.argsort(code, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(code[order])) + 1)

    def bundled(df: DataFrame, cells: tuple[str, ...], fn: Callable[..., Iterator[tuple]], schema: str, own: dict[str, pa.DataType]) -> DataFrame:
        """fn(the plan and block of a group, its rows of `cells`) for every group; what it yields are the columns `own`, beside
        those that a group has once."""
        once = [*keys, *fixed, "_totals"] if "data" in own else [*keys, "_n"]

        def run(table: pa.Table) -> pa.Table:
            plans = {c: table[c].to_numpy() for c in [*fixed, "_block"]}
            held = {c: np.array(table[c].to_pylist(), object) if c == "data" else table[c].to_numpy() for c in cells}
            totals = table["_totals"]
            source, out = [], []
            for at in groups(table):
                first = at[0]
                facts = (*(int(plans[c][first]) for c in fixed), int(plans["_block"][first]))
                for row in fn(facts, [held[c][at] for c in cells], lambda i=first: totals[int(i)].as_py()):
                    source.append(first)
                    out.append(row)
            sources = pa.array(source, pa.int64())
            found = {c: pa.array([row[i] for row in out], kind) for i, (c, kind) in enumerate(own.items())}
            return pa.table({c: table[c].take(sources) for c in once} | found)

        number = F.pmod(F.xxhash64(*group), F.lit(bundles))
        return df.withColumn("_bundle", number).groupBy("_bundle").applyInArrow(run, schema)

    def side_by_side(chunks: list[np.ndarray], height: int, width: int) -> np.ndarray:
        """[what, height, width] of the chunks of a group; columns without a chunk are 0."""
        out = None
        for at, wide, data in zip(*chunks, strict=True):
            part = np.frombuffer(data, complex).reshape(-1, height, wide)
            if out is None:
                out = np.zeros((len(part), height, width), complex)
            out[:, :, at : at + wide] = part
        return out

    def chunks(cells: np.ndarray, offset: int, height: int) -> Iterator[tuple]:
        """Blocks of `height` rows of [what, rows, columns], each a row to put out; their columns start at `offset`."""
        for i, s in enumerate(range(0, cells.shape[1], height)):
            yield i, offset, cells.shape[2], np.ascontiguousarray(cells[:, s : s + height]).tobytes()

    def over_residues(facts: tuple, held: list[np.ndarray], totals: Callable) -> Iterator[tuple]:
        n, m, n1, n2, chirped, block = facts
        t, wide = held[0], max(piece // n1, 1)
        low = block * wide
        width = min(wide, n2 - low)
        here = np.arange(low, low + width)
        cells = np.zeros((len(values) + chirped, n1, width), complex)
        for i, x in enumerate(held[1:]):
            cells[i, t // n2, t % n2 - low] = x * np.conj(chirp(t, n)) if chirped else x
        if chirped:
            places = np.arange(n1)[:, None] * n2 + here[None, :]
            back = m - places
            cells[-1] = np.where(places < n, chirp(np.minimum(places, n), n), np.where(back < n, chirp(np.minimum(back, n), n), 0))
        return chunks(np.fft.fft(cells, axis=1) * turned(np.arange(n1), here, m, -1), low, max(piece // n2, 1))

    def features(k: np.ndarray, power: np.ndarray, n: int, totals: list[float]) -> Iterator[tuple]:
        yield tuple(partial_features(k, p, n, s, include_dc, top) for p, s in zip(power, totals, strict=True))

    def gathered(facts: tuple, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        _, _, n1, n2, _, block = facts
        high = max(piece // n2, 1)
        low = block * high
        k1 = np.arange(low, min(low + high, n1))
        return k1, side_by_side(held, len(k1), n2)

    def over_blocks(facts: tuple, held: list[np.ndarray], totals: Callable) -> Iterator[tuple]:
        k1, cells = gathered(facts, held)
        n, _, n1, n2, _, _ = facts
        spectrum = np.fft.fft(cells, axis=2)
        k = k1[:, None] + n1 * np.arange(n2)[None, :]
        return features(k.ravel(), (np.abs(spectrum) ** 2).reshape(len(values), -1), n, totals())

    def and_back(facts: tuple, held: list[np.ndarray], totals: Callable) -> Iterator[tuple]:
        k1, cells = gathered(facts, held)
        _, m, n1, n2, _, _ = facts
        spectrum = np.fft.fft(cells, axis=2)
        inner = np.fft.ifft(spectrum[:-1] * spectrum[-1], axis=2) * turned(k1, np.arange(n2), m, 1)
        return chunks(inner.transpose(0, 2, 1), int(k1[0]), max(piece // n1, 1))

    def last_step(facts: tuple, held: list[np.ndarray], totals: Callable) -> Iterator[tuple]:
        n, _, n1, n2, _, block = facts
        wide = max(piece // n1, 1)
        low = block * wide
        j1 = np.arange(low, min(low + wide, n2))
        spectrum = np.fft.ifft(side_by_side(held, len(j1), n1), axis=2)
        k = j1[:, None] + n2 * np.arange(n1)[None, :]
        return features(k.ravel(), (np.abs(spectrum) ** 2).reshape(len(values), -1), n, totals())

    out_schema = f"{key_schema}, _n bigint, " + ", ".join(f"`{v}` {_PARTIAL}" for v in values)
    types = {f.name: f.type for f in to_arrow_schema(_parse_datatype_string(out_schema))}
    packed = {"_block": pa.int64(), "at": pa.int64(), "wide": pa.int64(), "data": pa.binary()}
    result, cells, chunk_cells = {v: types[v] for v in values}, ("_t", *values), ("at", "wide", "data")
    first, turned_first = (bundled(dealt.where(w), cells, over_residues, chunk, packed) for w in ("NOT chirp", "chirp"))
    straight = bundled(first, chunk_cells, over_blocks, out_schema, result)
    back = bundled(turned_first, chunk_cells, and_back, chunk, packed)
    parts = straight.unionByName(bundled(back, chunk_cells, last_step, out_schema, result))

    def merged(v: str) -> Column:
        best = F.slice(F.sort_array(F.flatten(F.collect_list(f"{v}.top")), asc=False), 1, top)
        return F.struct(*[F.sum(f"{v}.{f}").alias(f) for f in ("low", "mid", "high", "centre", "entropy")], best.alias("top")).alias(v)

    return parts.groupBy(*keys).agg(F.first("_n").alias("rows"), *map(merged, values))
