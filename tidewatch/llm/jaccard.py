"""N-gram Jaccard join: universe partition by size bands, pigeonhole, exact verification.

Two sets of sizes s <= r with Jaccard likeness of 0.8 or more differ in at most (r + s) / 9 <= s / 4 elements. Elements are
hashed into segments; with s / 4 + 1 + slack segments at least 1 + slack segments of such a pair are equal. How many
segments there are is fixed per band of sizes; a set is indexed under its own band, and under the one below when it is
small enough to have partners there. A set always uses the leading segments that its own size asks for.

Allocation by cost, per set: an empty segment, or one whose content is common (more than COMMON sets hold it), costs more
than it finds, so it gets nothing; the slack pays for that. All others get their exact content. Sets that would have to
skip more than their slack go to a second index with half as many, longer segments, each with its content and its
one-deletion neighbourhood (so each such segment counts twice in the pigeonhole). These sets are mostly the near-copy
families that hold each other's segments by the hundred: sets that meet in the second index form clusters, and those of a
cluster are compared in blocks of like sizes, after a bound from the number of segments that differ. Chance meetings chain
sets of no family into large clusters, the more the larger the table: the bands of the second index are narrow, so that few
segments are empty, and what is left of a crowded cluster is indexed once more among its own sets, under another partition of
the universe, until that splits it no further.

A pair that the index finds is held against the parity sketches of both sets first: sets that differ in d elements have
sketches that differ in at most d bits, so what differs in more bits than a link may in elements is dropped, and only the
texts of the rest are read. Equal sets are merged first, and a pair that is already connected is never looked at again, so copies cost one row each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.batches import map_texts, slices
from tidewatch.llm.components import connected
from tidewatch.llm.shingles import distinct, mixed, set_keys, shingle_sets
from tidewatch.session import discard, scratch_path, stored

#: Lower ends of the size bands: they double. Sets of fewer than four elements have no partners but equal ones.
BANDS = tuple(4 << i for i in range(40))
#: A segment content that more sets hold is common.
COMMON = 10
#: Sets of one block when sets are compared in blocks, and its elements: a worker holds the texts of two.
BLOCK = 2000
BLOCK_ELEMENTS = 500_000
#: Bands of the second index in one band of the first.
PARTS = 3
#: Index keys of the second index for an element, about.
SECOND_KEYS = 3
#: Bytes of index entries gathered in one group, and the least number of groups. A worker needs about four times that.
GROUP_BYTES = 12_000_000
GROUPS = 256
SECOND_GROUPS = 4
BAND_BITS = 6


def slack(n: int) -> int:
    return 3 + n // 10


def leading(n: int) -> int:
    """Segments that a set of n elements uses in the first index."""
    return n // 4 + 1 + slack(n)


def slack_pairs(n: int) -> int:
    return 2 + n // 40


def leading_pairs(n: int) -> int:
    """The same in the second index, where a segment may differ by one element, so half as many suffice."""
    return (n // 4 + 2) // 2 + slack_pairs(n)


def band_of(n: int) -> int:
    return int(n // 4).bit_length() - 1


def part_end(band: int, part: int) -> int:
    """The size at which a part of a band ends; the parts are the bands of the second index."""
    return math.ceil(BANDS[band] * 2 ** ((part + 1) / PARTS))


def parts_used(n: int, band: int) -> list[int]:
    """The parts of a band that hold the size of a set or that of a smaller partner."""
    return [k for k in range(PARTS) if part_end(band, k - 1) <= n and 5 * part_end(band, k) > 4 * n]


def segments(shingles: np.ndarray, band: int, second: bool, part: int = PARTS - 1, salt: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """(content hash, number of elements, segments used) for the leading segments of a set under the scheme of a band, in the
    second index that of a part of it."""
    width = leading_pairs if second else leading
    top = width(part_end(band, part) if second else 2 * BANDS[band])
    used = min(width(len(shingles)), top)
    place = (mixed(shingles, 101 + second + salt) % np.uint64(top)).astype(np.int64)
    content, size = np.zeros(top, np.uint64), np.bincount(place, minlength=top)
    with np.errstate(over="ignore"):
        np.add.at(content, place, mixed(shingles, 103))
    return content[:used], size[:used], used


def empty_segments(shingles: np.ndarray, band: int) -> int:
    """How many of the segments that a set uses in the first index have no element."""
    top = leading(2 * BANDS[band])
    used = min(leading(len(shingles)), top)
    place = (mixed(shingles, 101) % np.uint64(top)).astype(np.int64)
    return int((np.bincount(place, minlength=top)[:used] == 0).sum())


def sketch(shingles: np.ndarray) -> bytes:
    """A bit for every cell: whether an odd number of elements falls there. Between two and four cells an element."""
    cells = 1 << max(6, (2 * len(shingles) - 1).bit_length())
    place = (mixed(shingles, 109) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=cells) & 1).astype(np.uint8)).tobytes()


def bits_apart(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ: at most as many as their sets do in elements. The longer one is folded."""
    small, large = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(large) > len(small):
        large = large[: len(large) // 2] ^ large[len(large) // 2 :]
    return int(np.bitwise_count(small ^ large).sum())


def signatures(shingles: np.ndarray, band: int, second: bool, salt: int = 0) -> np.ndarray:
    """Index keys of a set under a band, with the band in the low bits: the content of its segments that are not empty, in
    the second index with every one-deletion content, under each part of the band. `salt` chooses the partition.

    What is empty, or becomes so by a deletion, is a key in the second index only when a set has more such segments than
    the slack of its least partner: otherwise some other segment of the pair agrees as well.
    """
    keys = []
    for part in parts_used(len(shingles), band) if second else [0]:
        content, size, used = segments(shingles, band, second, part, salt)
        numbers, filled = np.arange(used, dtype=np.uint64), size > 0
        if second:
            place = mixed(shingles, 102 + salt) % np.uint64(leading_pairs(part_end(band, part)))
            mine = place < used
            with np.errstate(over="ignore"):
                less = content[place[mine].astype(np.int64)] - mixed(shingles[mine], 103)
            left = size[place[mine].astype(np.int64)] > 1
            if int((size < 2).sum()) > slack_pairs(-(-4 * len(shingles) // 5)):
                filled[:], left[:] = True, True
            content, numbers = np.concatenate([content[filled], less[left]]), np.concatenate([numbers[filled], place[mine][left]])
        else:
            content, numbers = content[filled], numbers[filled]
        keys.append(mixed(mixed(content, 104) + numbers, 105 + second + (part << 8) + salt))
    key = np.concatenate(keys)
    return distinct((key & ~np.uint64((1 << BAND_BITS) - 1)) | np.uint64(band))


def bands_used(n: int) -> list[int]:
    """The band of a set, and the one below when a set of 0.8 times its size lies there."""
    if n < 4:
        return []
    band = band_of(n)
    return [band, band - 1] if band and 4 * n < 5 * BANDS[band] else [band]


def handle_of(shingles: np.ndarray, clashes: frozenset[int]) -> tuple[int, bytes]:
    """64 bits by which a set goes through the joins, and the 128 that stand for it. Where two sets of the table have the
    same first half, both go by their second."""
    one, whole = set_keys(shingles)
    return (int.from_bytes(whole[8:], "little", signed=True) if one in clashes else one), whole


def described(docs: DataFrame, id: str, text: str, clashes: frozenset[int]) -> DataFrame:
    """Per document: doc, key (two hashes of its text), set (16 bytes, NULL when empty), h (handle), n, band, the empty segments
    that it has under its band and, where it is used, under the one below, and sketch (NULL for sets that have no band)."""
    kind = dict(docs.dtypes)[id]

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in parts:
            sets = shingle_sets(part[text])
            keys = [handle_of(s, clashes) if len(s) else (None, None) for s in sets]
            empty = [[empty_segments(s, b) for b in bands_used(len(s))] for s in sets]
            yield {
                "doc": part[id],
                "key": part["_key"],
                "set": [k[1] for k in keys],
                "h": [k[0] for k in keys],
                "n": [len(s) for s in sets],
                "band": [bands_used(len(s))[0] if len(s) >= 4 else None for s in sets],
                "empty": [e[0] if e else 0 for e in empty],
                "empty_below": [e[1] if len(e) > 1 else 0 for e in empty],
                "sketch": [sketch(s) if len(s) >= 4 else None for s in sets],
            }

    schema = f"doc {kind}, key {KEY}, set binary, h bigint, n bigint, band bigint, empty bigint, empty_below bigint, sketch binary"
    return map_texts(docs.select(id, text, text_key(text).alias("_key")), run, schema, text)


KEY = "struct<one: bigint, two: bigint>"


def text_key(text: str) -> F.Column:
    """128 bits that stand for a text."""
    return F.struct(F.xxhash64(F.col(text)).alias("one"), F.xxhash64(F.lit(KEY), F.col(text)).alias("two"))


#: Segments a set may skip and still be found by every partner that skips no more: the slack of its least partner.
ALLOWANCE = "3 + ceil(n * 4 / 5) div 10"


def repeated_keys(texts: DataFrame, text: str, second: bool, size_hint: int, clashes: frozenset[int], salt: int = 0) -> DataFrame:
    """sig, h, pivot (the first set of the key), c (its sets): the index keys that at least two different sets have. Entries
    are packed per group of keys, sets that are equal within a batch enter once. Of the second index, links (a, b) that
    connect the sets of one `cluster` that have a key of a group: what meets there is compared in blocks anyway."""
    groups = max(SECOND_GROUPS if second else GROUPS, -(-size_hint * 16 // GROUP_BYTES))

    def index(parts: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in parts:
            keys, handles, seen = [], [], set()
            for s, cluster in zip(shingle_sets(part[text]), part.get("cluster", repeat(0)), strict=False):
                if len(s) < 4 or (h := handle_of(s, clashes)[0]) in seen:
                    continue
                seen.add(h)
                own = np.concatenate([signatures(s, b, second, salt) for b in bands_used(len(s))])
                keys.append(mixed(own, cluster) if second else own)
                handles.append(np.full(len(own), h, np.int64))
            if not keys:
                continue
            key, handle = np.concatenate(keys), np.concatenate(handles)
            group = (key >> np.uint64(BAND_BITS)) % np.uint64(groups)
            order = np.lexsort((key, group))
            key, handle, group = key[order], handle[order], group[order].astype(np.int64)
            cut = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
            yield {
                "part": group[cut].tolist(),
                "entries": [_packed(key[a:b], handle[a:b]) for a, b in zip(cut, [*cut[1:], len(key)], strict=True)],
            }

    packed = map_texts(texts.select(text, *(["cluster"] if second else [])), index, "part bigint, entries binary", text)
    if second:
        return packed.groupBy("part").applyInArrow(lambda table: links_met(table["entries"]), "a bigint, b bigint")
    return packed.groupBy("part").applyInArrow(lambda table: keys_met(table["entries"]), "sig bigint, h bigint, pivot bigint, c bigint")


def keys_met(entries: pa.ChunkedArray) -> pa.Table:
    """sig, h, pivot, c of one group's entries; see `repeated_keys`."""
    key, handle, pivot, own = _met(entries)
    return pa.table({"sig": key.view(np.int64), "h": handle, "pivot": pivot, "c": own})


def links_met(entries: pa.ChunkedArray) -> pa.Table:
    """Links that connect the sets of every key of one group's entries. Families share keys by the hundred, so what they say
    is made distinct first."""
    a, b = _forest(*_distinct_pairs(*_met(entries)[1:3]))
    return pa.table({"a": a, "b": b})


def _met(entries: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """key, handle, first handle of the key and handles of the key, for keys of at least two handles."""
    key, handle = _distinct_pairs(*_gathered(entries))
    run = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(run, len(key)))
    several = np.repeat(count > 1, count)
    run, count = run[count > 1], count[count > 1]
    return key[several], handle[several], np.repeat(handle[run], count), np.repeat(count, count)


def _distinct_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, in order."""
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    fresh = np.ones(len(left), bool)
    fresh[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    return left[fresh], right[fresh]


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node with the least one that the given links lead to: one row for each, however many links there are."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return nodes[label != np.arange(len(nodes))], nodes[label[label != np.arange(len(nodes))]]


def _packed(key: np.ndarray, handle: np.ndarray) -> bytes:
    """Byte by byte in planes: sorted keys have runs in their high bytes, which compress in the shuffle."""
    return np.stack([key, handle.view(np.uint64)]).view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1).tobytes()


def _gathered(entries: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and handles of all entries of a group, read from Arrow's memory into one array."""
    both = np.empty((2, sum(pc.sum(pc.binary_length(c)).as_py() or 0 for c in entries.chunks) // 16), np.uint64)
    planes, at = both.view(np.uint8).reshape(2, -1, 8), 0
    for packed in entries:
        own = np.frombuffer(packed.as_buffer(), np.uint8).reshape(2, 8, -1)
        planes[:, at : at + own.shape[2]] = own.transpose(0, 2, 1)
        at += own.shape[2]
    return both[0], both[1].view(np.int64)


def texts_of(docs: DataFrame, text: str, handles: DataFrame, sets: DataFrame) -> DataFrame:
    """h, n, sketch, text: one text for each of the sets in `handles`, found by its key; no text is read as a set for that."""
    wanted = sets.join(handles, "h", "left_semi").select("h", "n", "sketch", "key.*")
    own = docs.select(F.col(text).alias("text"), text_key(text).alias("key")).select("text", "key.*")
    return own.join(wanted, ["one", "two"]).dropDuplicates(["one", "two"]).select("h", "n", "sketch", "text")


def likely(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) without those whose sizes or sketches rule a link out."""
    left, right = (texts.select(F.col("h").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab")
    both = pairs.select("a", "b").join(left, "a").join(right, "b").where("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)")
    both = both.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), "sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, x, y = (batch.column(c).to_pylist() for c in ("n", "sketch_a", "sketch_b"))
            near = [9 * bits_apart(p, q) <= m for m, p, q in zip(n, x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= 80 * union. Of the texts those of the pairs alone are moved when
    the pairs are few."""
    ends = pairs.select(F.col("a").alias("h")).union(pairs.select(F.col("b").alias("h")))
    own = texts.join(ends, "h", "left_semi")
    left = own.select(F.col("h").alias("a"), F.col("text").alias("text_a"))
    right = own.select(F.col("h").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=200)
        def shingles(text: str) -> np.ndarray:
            return shingle_sets([text])[0]

        for batch in slices(batches, "text_a"):
            texts = zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True)
            alike = pa.array([linked(shingles(x), shingles(y)) for x, y in texts], pa.bool_())
            yield batch.select(["a", "b"]).filter(alike)

    return both.mapInArrow(run, "a bigint, b bigint")


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    small, large = sorted((len(x), len(y)))
    if 5 * small < 4 * large:
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= 80 * (len(x) + len(y) - common)


def best_pivots(keys: DataFrame) -> DataFrame:
    """For every set the one, of those that come first under one of its keys, that shares most keys with it."""
    shared = keys.where("h <> pivot").groupBy("h", "pivot").agg(F.count("*").alias("n"))
    best = shared.groupBy("h").agg(F.max(F.struct("n", "pivot")).alias("best"))
    return best.select(F.col("h").alias("a"), F.col("best.pivot").alias("b"))


def open_keys(keys: DataFrame, roots: DataFrame) -> DataFrame:
    """The keys whose sets are not all connected yet, with the root of every set."""
    rooted = keys.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    spread = rooted.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return rooted.join(spread.select("sig"), "sig", "left_semi")


def pairs_within(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Unconnected pairs that share as many keys as a link needs: of the leading segments of the smaller set, s / 4 + 1 and
    its slack, at most (r + s) / 9 differ and at most the slack are common or empty. Keys have at most COMMON sets here."""
    own = rows.where(F.col("c") <= COMMON).join(sets.select("h", "n"), "h")
    left = own.select("sig", F.col("h").alias("a"), F.col("root").alias("root_a"), F.col("n").alias("n_a"))
    right = own.select("sig", F.col("h").alias("b"), F.col("root").alias("root_b"), F.col("n").alias("n_b"))
    met = left.join(right, "sig").where("a < b AND root_a <> root_b").groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared"))
    return met.where("shared >= least(n_a, n_b) div 4 + 1 - (n_a + n_b) div 9").select("a", "b")


def short_of_slack(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """h of the sets whose common keys and empty segments under some band are more than they may skip."""
    band = F.col("sig").bitwiseAND((1 << BAND_BITS) - 1)
    common = rows.where(F.col("c") > COMMON).groupBy("h", band.alias("under")).agg(F.count("*").alias("common"))
    skipped = F.col("common") + F.when(F.col("under") == F.col("band"), F.col("empty")).otherwise(F.col("empty_below"))
    return common.join(sets, "h").where(skipped > F.expr(ALLOWANCE)).select("h").distinct()


def clustered(second: DataFrame, roots: DataFrame, stored: Callable[[DataFrame, str], DataFrame], clashes: frozenset[int]) -> DataFrame:
    """h, n, root, cluster: the sets of `second` (h, n, text) that meet others in the second index. Linked sets meet under every
    partition of the universe, so clusters of more than a block are split by another one, until a turn leaves more than
    half of their sets in such clusters."""
    rooted = second.select("h", "n").join(roots, "h", "left").select("h", "n", F.coalesce("root", "h").alias("root"))
    crowd, done, before = rooted.withColumn("cluster", F.lit(0).cast("bigint")), [], None
    for turn in count():
        sums = [F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("sets")]
        size, sets = crowd.agg(*sums).first()
        if not sets or before and 2 * sets > before:
            break
        before = sets
        texts = second.join(crowd.select("h", "cluster"), "h") if turn else second.withColumn("cluster", F.lit(0).cast("bigint"))
        near = stored(repeated_keys(texts, "text", True, SECOND_KEYS * size, clashes, turn << 16).distinct(), f"near-{turn}")
        found = stored(crowd.drop("cluster").join(connected(near).select("h", F.col("root").alias("cluster")), "h"), f"clusters-{turn}")
        sizes = found.groupBy("cluster").agg(F.count("*").alias("sets"), (F.min("root") < F.max("root")).alias("apart"))
        found = found.join(sizes.where("apart"), "cluster")
        done.append(found.where(F.col("sets") <= BLOCK).drop("sets", "apart"))
        crowd = found.where(F.col("sets") > BLOCK).drop("sets", "apart")
    for part in done:
        crowd = crowd.unionByName(part)
    return crowd


def dealt(second: DataFrame, clusters: DataFrame) -> DataFrame:
    """cluster, class, low, high (a pair of blocks), own, block, h, root, text: the sets of a cluster as `in_blocks` compares
    them. Sizes are put into classes a quarter apart, so links are within a class or with the next one; the sets of a class
    and the next are cut into blocks, and each block meets every other once. A text is there once for every block of its
    class, so a block is as large as a worker can hold; classes that cannot have a new link are left out."""
    own = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int")
    rows = clusters.withColumn("own", own).withColumn("class", F.explode(F.array(F.col("own"), F.col("own") - 1)))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias("blocks")
    meeting = F.bool_or(F.col("own") == F.col("class")) & (F.min("root") < F.max("root"))
    counts = rows.groupBy("cluster", "class").agg(blocks, meeting.alias("meeting")).where("meeting")
    rows = rows.join(counts, ["cluster", "class"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
    # Block i meets j >= i: a set goes to all pairs of blocks that hold its own.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = rows.select("cluster", "class", "own", "block", "h", "root", other.alias("other"))
    spread = spread.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    return second.select("h", "text").join(spread, "h")


def in_blocks(second: DataFrame, clusters: DataFrame) -> DataFrame:
    """Links between sets of one cluster. Only links that connect what was apart come out: at most one less than a pair of
    blocks has sets."""

    def meet(table: pa.Table) -> pa.Table:
        a, b = [], []
        h, root, block = (table[c].to_numpy() for c in ("h", "root", "block"))
        first = table["own"].to_numpy() == table["class"].to_numpy()
        if not first.any() or (root == root[0]).all():
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        sets = shingle_sets(table["text"].to_pylist())
        n = np.array([len(s) for s in sets], np.int64)
        # Sets that differ in d elements differ in at most d of these segments.
        width = 1 << max(3, int(n.max() // 2).bit_length())
        shape = np.zeros((len(sets), width), np.uint16)
        with np.errstate(over="ignore"):
            for row, s in zip(shape, sets, strict=True):
                np.add.at(row, (mixed(s, 107) % np.uint64(width)).astype(np.int64), mixed(s, 108).astype(np.uint16))
        mixed_blocks = block.min() != block.max()
        # Roots that pairs of this block have joined so far: what they connect is not compared again, so a block puts out
        # fewer links than it has sets.
        kin, number = np.unique(root, return_inverse=True)
        group = np.arange(len(kin))
        for i in range(len(sets)):
            ahead = np.arange(i + 1, len(sets))
            near = ahead[(group[number[ahead]] != group[number[i]]) & (4 * n[ahead] <= 5 * n[i]) & (5 * n[ahead] >= 4 * n[i])]
            near = near[first[near] | first[i]]
            if mixed_blocks:
                near = near[block[near] != block[i]]
            if len(near):
                apart = (shape[near] != shape[i]).sum(axis=1)
                near = near[9 * apart <= n[near] + n[i]]
            for j in near.tolist():
                mine, other = group[number[i]], group[number[j]]
                if mine != other and linked(sets[i], sets[j]):
                    a.append(int(h[i]))
                    b.append(int(h[j]))
                    group[group == other] = mine
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt(second, clusters).groupBy("cluster", "class", "low", "high").applyInArrow(meet, "a bigint, b bigint")


def ngram_components(docs: DataFrame, id: str = "doc_id", text: str = "text", keep_key: bool = False) -> DataFrame:
    """Per row of `docs`: `id`, n_shingles, component_id: the least id that links lead to, itself included. With `keep_key`
    also key, which stands for the text.

    Two documents link when 100 * intersection >= 80 * union of their sets of five-word shingles. Null or empty texts, and
    texts without words, have no shingles and are linked with nothing. Rows with a null id take part and are never the least
    one unless all are null; repeated rows each give a row; an empty table gives none; other columns are not read. Work
    tables lie in the shared folder; those that the result does not read are removed. Sets are told apart by 128-bit hashes.
    """
    spark = docs.sparkSession

    paths: dict[str, str] = {}

    def kept(df: DataFrame, label: str) -> DataFrame:
        paths[label] = scratch_path(spark, f"ngram-{label}")
        return stored(df, paths[label])

    clashes: frozenset[int] = frozenset()
    while True:
        base = kept(described(docs, id, text, clashes), "sets")
        columns = [F.max(c).alias(c) for c in ("n", "band", "empty", "empty_below", "sketch")]
        same = [F.min("doc").alias("least"), F.min("set").alias("set"), F.max("set").alias("other"), F.min("key").alias("key"), *columns]
        sets = kept(base.where("h IS NOT NULL").groupBy("h").agg(*same), "distinct")
        # Two sets in 2^64: none, or a handful in the largest tables.
        found = {r["h"] for r in sets.where("set <> other").select("h").collect()}
        if not found:
            break
        clashes |= found
    held = sets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    keys = kept(repeated_keys(docs, text, False, held // 2, clashes), "keys")
    sparse = sets.where(f"greatest(empty, empty_below) > {ALLOWANCE}").select("h")
    texts = kept(texts_of(docs, text, keys.select("h").union(sparse).distinct(), sets), "texts")

    def checked(pairs: DataFrame, label: str) -> DataFrame:
        return kept(verified(kept(likely(pairs, texts), f"likely-{label}"), texts), label)

    star = checked(best_pivots(keys), "star")
    roots = kept(connected(star), "roots")
    waiting = kept(open_keys(keys, roots), "open")
    links = [star, checked(pairs_within(waiting, sets), "pairs")]

    short = short_of_slack(waiting, sets).union(sparse).distinct()
    second = kept(texts.select("h", "n", "text").join(short, "h", "left_semi"), "short")
    if not second.isEmpty():
        clusters = kept(clustered(second, roots, kept, clashes), "clusters")
        links.append(kept(in_blocks(second, clusters), "blocks"))
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    final = kept(connected(edges), "components")
    discard(spark, [path for label, path in paths.items() if label not in ("sets", "distinct", "components")])
    member = sets.join(final, "h", "left").select("h", "n", "least", F.coalesce("root", "h").alias("root"))
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(smallest, "root").select("h", "component_id")
    return base.join(named, "h", "left").select(
        F.col("doc").alias(id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("h").isNull(), F.col("doc")).otherwise(F.col("component_id")).alias("component_id"),
        *(["key"] if keep_key else []),
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, without those whose component has a smaller id; rows that repeat an id and its text
    are one. Where an id has several texts, each is judged with its own component. Rows with a null id stay, as nothing tells
    them apart; so do null and empty texts, once for an id; an empty table gives none."""
    found = ngram_components(docs, id, text, keep_key=True).where(F.col(id).isNotNull())
    marked = found.groupBy(F.col(id).alias("_id"), F.col("key.one").alias("_one"), F.col("key.two").alias("_two")).agg(
        F.min(F.col("component_id") == F.col(id)).alias("_least"), (F.count("*") > 1).alias("_again")
    )
    marked = marked.where("NOT _least OR _again")
    key = text_key(text)
    same = (F.col(id) == F.col("_id")) & (key["one"] == F.col("_one")) & (key["two"] == F.col("_two"))
    rows = docs.join(marked, same, "left").where("coalesce(_least, true)")
    once = rows.where("coalesce(_again, false)").dropDuplicates([id, text])
    return rows.where("NOT coalesce(_again, false)").unionByName(once).select(*docs.columns)
