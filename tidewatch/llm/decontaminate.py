"""Benchmark decontamination: shared q-grams counted in diagonal bands, then banded alignment of what is left.

A place where an item occurs with at most e edits shares at least length + 1 - q (e + 1) q-grams with it, and their
diagonals (place in its text minus place in the item) differ by at most e. So hits are counted per text and item in bands of
2 W diagonals that start every W, with W >= e of that item: an occurrence lies wholly in one of them, and no band holds two
that do not overlap or reaches into another text. Bands that reach the bound are aligned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.batches import map_texts, pieces
from tidewatch.llm.language import lowered

#: Characters of a q-gram, and edits allowed per character of an item.
Q = 8
EDITS = 0.08
#: Benchmark characters searched at once; a larger benchmark is searched in that many passes, each over all documents.
BLOCK_CHARS = 4_000_000
#: Document characters looked up at once, and hits expanded at once.
CHUNK_CHARS = 400_000
#: Meetings of a gram of the texts with a place in an item that are worked out at once.
MOST_HITS = 2_000_000
FILTER_BITS = 22
_MULTIPLIERS = np.random.default_rng(8).integers(1, 2**63, Q, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WHITE = (9, 10, 11, 12, 13, 0x20, 0x85, 0xA0, 0x2028, 0x2029, 0x3000, *range(0x2000, 0x200B))
_END = 0x10FFFF


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with runs of white space as one blank, and the place of each in the text."""
    codes = np.frombuffer(lowered(text).encode("utf-32-le", "surrogatepass"), np.uint32)
    white = np.isin(codes, _WHITE) if not text.isascii() else (codes == 0x20) | ((codes >= 9) & (codes <= 13))
    keep = ~white
    keep[1:] |= white[1:] & ~white[:-1]
    keep[:1] = ~white[:1]
    at = np.flatnonzero(keep)
    return np.where(white, 0x20, codes)[at].astype(np.uint32), at


def grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the q-gram that starts at each place."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(codes) - Q + 1, np.uint64)
    for j in range(Q):
        out += codes[j : j + len(out)].astype(np.uint64) * _MULTIPLIERS[j]
    out ^= out >> np.uint64(31)
    return out * np.uint64(0x9E3779B97F4A7C15)


def budget(length: int) -> int:
    """Edits allowed for an item: the rate, or what leaves at least one shared q-gram to be counted."""
    return max(0, min(int(EDITS * length), length // Q - 1))


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, limit: int, anchored: bool = False) -> tuple[int, int] | None:
    """(edits, end in text) of the best occurrence of `item` that starts on a diagonal from low to high, or None beyond
    `limit`. Only diagonals within `limit` of those are worked out. `anchored`: it must start at the start of the text."""
    first, width = low - limit, high - low + 2 * limit + 1
    diagonal = np.arange(width)
    at = first + diagonal
    far = np.int64(1 << 30)
    cost = np.where((at >= 0) & (at <= len(text)), np.maximum(at, 0) if anchored else 0, far)
    padded = np.concatenate([text.astype(np.int64), [-1]])
    for i, symbol in enumerate(item.tolist()):
        place = first + diagonal + i
        inside = (place >= 0) & (place < len(text))
        differs = padded[np.where(inside, place, len(text))] != symbol
        step = np.where(inside, cost + differs, far)
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)
        step = np.where((place + 1 >= 0) & (place + 1 <= len(text)), step, far)
        cost = np.minimum.accumulate(step - diagonal) + diagonal
        cost = np.where((place + 1 >= 0) & (place + 1 <= len(text)), cost, far)
        if cost.min() > limit:
            return None
    best = int(cost.argmin())
    return int(cost[best]), first + best + len(item)


@dataclass
class Benchmark:
    """The items of one block and the places of their q-grams, by gram."""

    ids: list
    items: list[np.ndarray]
    gram: np.ndarray
    start: np.ndarray
    count: np.ndarray
    item: np.ndarray
    place: np.ndarray
    maybe: np.ndarray
    bound: np.ndarray
    edits: np.ndarray
    width: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Benchmark:
        known = [(i, codes) for i, t in rows if len(codes := _stripped(t))]
        items = [c for _, c in known]
        hashed = [grams(c) for c in items]
        gram = np.concatenate([*hashed, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(items)), [len(h) for h in hashed])
        place = np.concatenate([*[np.arange(len(h)) for h in hashed], np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(gram, kind="stable")
        gram, item, place = gram[order], item[order], place[order]
        distinct, start, count = np.unique(gram, return_index=True, return_counts=True)
        maybe = np.zeros(1 << FILTER_BITS, bool)
        maybe[distinct >> np.uint64(64 - FILTER_BITS)] = True
        edits = np.array([budget(len(c)) for c in items], np.int64)
        bound = np.array([len(c) + 1 - Q * (e + 1) for c, e in zip(items, edits.tolist(), strict=True)], np.int64)
        return cls([i for i, _ in known], items, distinct, start, count, item, place, maybe, bound, edits, np.maximum(edits, 1))

    def hits(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) of every occurrence, in code points of the text."""
        low, held = 0, 0
        for i, t in enumerate([*texts, None]):
            if i > low and (i == len(texts) or held > CHUNK_CHARS):
                for text, *found in self._chunk(texts[low:i]):
                    yield low + text, *found
                low, held = i, 0
            held += len(t or "")

    def _chunk(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        parts = [normalised(t or "") for t in texts]
        edge = np.cumsum([0, *[len(c) + 1 for c, _ in parts]])
        codes = np.concatenate([x for c, _ in parts for x in (c, np.array([_END], np.uint32))])
        for text, item, start, end, edits in self._candidates(codes, edge):
            at = parts[text][1]
            yield text, item, int(at[start]), int(at[end - 1]) + 1, edits

    def _candidates(self, codes: np.ndarray, edge: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        # Bands come in rising order: where the last occurrence of the item ends, the next may start.
        ends: dict[tuple[int, int], int] = {}
        for text, item, low in sorted(self._bands(codes, edge) | self._short(codes, edge)):
            free, high = ends.get((text, item), 0), low + 2 * int(self.width[item]) - 1
            if free > high + int(self.edits[item]):
                continue  # a band below has found what lies in this one
            own = codes[edge[text] : edge[text + 1] - 1]
            found = self._as_it_is(item, own, max(low, free), high) or self._with_edits(item, own, free, low, high)
            if found:
                ends[text, item] = found[1]
                yield text, item, *found

    def _as_it_is(self, item: int, own: np.ndarray, floor: int, high: int) -> tuple[int, int, int] | None:
        pattern = self.items[item]
        region, wanted, at = own[floor : max(high + 1, 0) + len(pattern)].tobytes(), pattern.tobytes(), -1
        while (at := region.find(wanted, at + 1)) >= 0:
            if at % 4 == 0:
                return floor + at // 4, floor + at // 4 + len(pattern), 0
        return None

    def _with_edits(self, item: int, own: np.ndarray, free: int, low: int, high: int) -> tuple[int, int, int] | None:
        pattern, limit, rest = self.items[item], int(self.edits[item]), own[free:]
        found = align(pattern, rest, low - free, high - free, limit) if limit else None
        if not found:
            return None
        edits, end = found
        # Back from the end, for the start.
        _, length = align(pattern[::-1], rest[:end][::-1], 0, 0, edits, anchored=True)
        return free + end - length, free + end, edits

    def _bands(self, codes: np.ndarray, edge: np.ndarray) -> set[tuple[int, int, int]]:
        """(text, item, lowest diagonal) of the bands that reach the bound of their item."""
        hashed = grams(codes)
        at = np.flatnonzero(self.maybe[hashed >> np.uint64(64 - FILTER_BITS)])
        if not len(at) or not len(self.gram):
            return set()
        rank = np.searchsorted(self.gram, hashed[at]).clip(max=len(self.gram) - 1)
        same = self.gram[rank] == hashed[at]
        at, rank = at[same], rank[same]
        count = self.count[rank]
        text = np.searchsorted(edge, at, "right") - 1
        own = at - edge[text]
        # Hits are expanded in bounded pieces: first the pairs of text and item that occur, then their counts by slot.
        cuts = np.flatnonzero(np.diff(np.cumsum(count) // MOST_HITS, prepend=0))
        parts = [slice(a, b) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True) if a < b]
        pairs = np.zeros(0, np.int64)
        for part in parts:
            item, _ = self._expanded(rank[part], count[part])
            pairs = np.union1d(pairs, np.repeat(text[part], count[part]) * len(self.items) + item)
        # The slot below the lowest one is left free, for the band that starts there.
        base = -int(max(len(c) for c in self.items)) - 1
        slots = int(own.max()) - base + 2
        key, hits = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in parts:
            item, place = self._expanded(rank[part], count[part])
            diagonal = np.repeat(own[part], count[part]) - place
            pair = np.searchsorted(pairs, np.repeat(text[part], count[part]) * len(self.items) + item)
            fresh, n = np.unique(pair * slots + (diagonal // self.width[item] - base), return_counts=True)
            key, back = np.unique(np.concatenate([key, fresh]), return_inverse=True)
            hits = np.bincount(back, np.concatenate([hits, n]), len(key)).astype(np.int64)
        # A band is a slot and the one above it.
        lower, place = np.concatenate([key, key - 1]), np.concatenate([hits, hits])
        band, back = np.unique(lower, return_inverse=True)
        total = np.bincount(back, place, len(band))
        text, item = np.divmod(pairs[band // slots], len(self.items))
        low = (band % slots + base) * self.width[item]
        reached = total >= self.bound[item]
        return set(zip(text[reached].tolist(), item[reached].tolist(), low[reached].tolist(), strict=True))

    def _expanded(self, rank: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place) of all entries of some grams."""
        first = np.cumsum(count) - count
        entry = np.arange(int(count.sum())) + np.repeat(self.start[rank] - first, count)
        return self.item[entry], self.place[entry]

    def _short(self, codes: np.ndarray, edge: np.ndarray) -> set[tuple[int, int, int]]:
        """Items shorter than a q-gram: every place where they stand."""
        out = set()
        short = [i for i, c in enumerate(self.items) if len(c) < Q]
        if short:
            whole = codes.tobytes().decode("utf-32-le", "surrogatepass")
            for i in short:
                text, at = self.items[i].tobytes().decode("utf-32-le", "surrogatepass"), -1
                while (at := whole.find(text, at + 1)) >= 0:
                    own = int(np.searchsorted(edge, at, "right")) - 1
                    out.add((own, i, at - int(edge[own])))
        return out


def _stripped(text: str | None) -> np.ndarray:
    codes, _ = normalised(text or "")
    return codes[:-1] if len(codes) and codes[-1] == 0x20 else codes


def _blocks(benchmark: DataFrame, id: str, text: str) -> Iterator[list[tuple]]:
    """The items in blocks of about BLOCK_CHARS characters, one at a time on the driver."""
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_CHARS))
    for b in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b) if blocks > 1 else rows
        yield sorted(((r["id"], r["text"]) for r in own.collect()), key=repr)


def find_leaks(
    df: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per occurrence: `id`, `item`, start, end (code points of the text, end exclusive) and edits.

    Both sides are compared in lower case with white space collapsed; an item may differ in 8 % of its characters (fewer
    where q-grams could not show it; items under 16 characters must occur as they are). Items are
    found whole: a text that quotes a part of one gives no row. Occurrences of one item do not
    overlap. Null and empty texts or items give no rows, null ids stay, repeated rows each give their rows, empty tables
    give none; other columns are not read. No shuffle: blocks of the benchmark, of bounded size, are broadcast.
    """
    kind, item_kind = dict(df.dtypes)[id], dict(benchmark.dtypes)[item]
    schema = f"`{id}` {kind}, `{item}` {item_kind}, start bigint, end bigint, edits bigint"
    out = None
    for rows in _blocks(benchmark, item, item_text):
        shared = df.sparkSession.sparkContext.broadcast(Benchmark.of(rows))

        def run(parts: Iterator[dict[str, list]], shared=shared) -> Iterator[dict[str, list]]:
            for part in parts:
                hits = list(shared.value.hits(part[text]))
                cells = [list(x) for x in zip(*hits, strict=True)] or [[], [], [], [], []]
                yield {
                    id: [part[id][i] for i in cells[0]],
                    item: [shared.value.ids[i] for i in cells[1]],
                    **dict(zip(("start", "end", "edits"), cells[2:], strict=True)),
                }

        found = map_texts(df.select(id, text), run, schema, text)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `df`, with all their columns, whose text holds no item of the benchmark. Null and empty texts, null ids and
    repeated rows stay; without items all rows do; an empty table gives none."""
    for rows in _blocks(benchmark, item, item_text):
        shared = df.sparkSession.sparkContext.broadcast(Benchmark.of(rows))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                at = 0
                for part in pieces([batch.select([text])], text):
                    for i, *_ in shared.value.hits(part[text]):
                        clean[at + i] = False
                    at += len(part[text])
                yield batch.filter(pa.array(clean))

        df = df.mapInArrow(run, df.schema)
    return df
