"""Document fingerprints from closed syncmers. Built-in functions only.

A k-mer of characters is kept when the smallest of the s-mers within it is its first or its last one. Whether it is kept
depends on its own characters alone, so an edit elsewhere never moves these anchors. A fingerprint is the set of neighbours:
of every anchor, a hash of itself, of the next one, and of the distance between them. So two texts are alike as far as their
anchors stand in the same order and at the same distances, wherever the passage has moved to, and likeness is worked out
from the fingerprints alone.

As anchors are free of context, neighbours in a text pasted together come from those in its parts; only the seam is read again.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of a k-mer and of an s-mer.
K = 10
S = 5
#: Bits of a place in packed anchors; texts of more characters than that do not fit a row of arrays.
PLACE = 28
#: Bits of a neighbour hash.
BITS = 32
#: Rows of one ordered slice when neighbours in id order are looked up, and the most slices.
SLICE_ROWS = 250
MOST_SLICES = 8192
#: Bytes of a text id, behind what all of them begin with, that tell slices apart.
ID_BYTES = 6


def plain(text: str) -> F.Column:
    """The text in lower case, with runs of white space as one blank and none at the ends. The capital sigma, the one letter
    whose lower case depends on what follows, becomes the small one first, so parts of a text give parts of its plain form."""
    return F.btrim(F.regexp_replace(F.lower(F.replace(F.expr(text), F.lit("Σ"), F.lit("σ"))), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " "))


def anchors(own: str, k: int = K, s: int = S) -> str:
    """SQL of the anchors of a plain text, in order: hash (35 bits) and place, packed. A text of fewer than k characters has
    one, an empty one none. With k <= 2 s the s-mers at both ends cover the k-mer, so their hashes make its hash."""
    if not s < k <= 2 * s:
        raise ValueError("Closed syncmers here need s < k <= 2 s")
    last = k - s
    # Where every character is one byte, an s-mer is read from its place; else all of them are cut out by one expression.
    bytewise = f"transform(sequence(1, greatest(length(b) - {s - 1}, 1)), i -> xxhash64(substring(b, i, {s})))"
    bytewise = f"transform(array(encode({own}, 'utf-8')), b -> {bytewise})[0]"
    matched = f"transform(regexp_extract_all({own}, '(?s)(?=(.{{{s}}})).', 1), w -> xxhash64(w))"
    inner = f"if(length({own}) = octet_length({own}), {bytewise}, {matched})"
    # The smaller end is held against one s-mer after the other, as most k-mers fail at the first ones.
    left, right = (" AND ".join(f"{end} <= v[i + {j}]" for j in range(1, last)) or "true" for end in ("v[i]", f"v[i + {last}]"))
    places = f"filter(sequence(0, size(v) - {last + 1}), i -> if(v[i] <= v[i + {last}], {left}, {right}))"
    packed = f"shiftleft(shiftrightunsigned(%s, 29), {PLACE})"
    marks = f"transform({places}, i -> {packed % f'xxhash64(v[i], v[i + {last}])'} | cast(i as bigint))"
    few = f"if({own} = '', cast(array() as array<bigint>), array({packed % f'xxhash64({own})'}))"
    return f"transform(array({inner}), v -> if(size(v) <= {last}, {few}, {marks}))[0]"


def links(packed: str) -> str:
    """SQL of the neighbour hash of every anchor of an array, in order, packed behind its place; the last has itself alone."""
    mask = (1 << PLACE) - 1
    pair = f"xxhash64(shiftright(x, {PLACE}), shiftright(y, {PLACE}), (y & {mask}L) - (x & {mask}L))"
    own = f"if(y IS NULL, xxhash64(shiftright(x, {PLACE})), {pair})"
    kept = f"shiftrightunsigned({own}, {64 - BITS}) | shiftleft(x & {mask}L, {BITS})"
    return f"transform(array({packed}), v -> zip_with(v, slice(v, 2, size(v)), (x, y) -> {kept}))[0]"


def hashes(linked: str) -> str:
    """SQL of the neighbour hashes of an array of links."""
    return f"transform({linked}, x -> x & {(1 << BITS) - 1}L)"


def neighbours(packed: str) -> str:
    """SQL of the distinct neighbour hashes of an array of anchors."""
    return f"array_distinct({hashes(links(packed))})"


def written(own: str) -> F.Column:
    """A fingerprint as text: for every hash a 1 and its hexadecimal digits."""
    return F.expr(f"array_join(transform({own}, x -> hex(x | {1 << BITS}L)), '')")


def likeness(a: str, b: str, common: F.Column | None = None) -> F.Column:
    """Jaccard likeness of two fingerprints, given as arrays of hashes. Two empty ones are alike (1). `common`: the number
    of hashes that both have, where it is known."""
    both = F.size(F.array_intersect(a, b)) if common is None else common
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(both / (total - both))


def id_code(df: DataFrame, id: str) -> F.Column:
    """A double that never falls as the id rises; null ids have none. Text ids go by their first bytes behind what all of
    them share; ids that are neither numbers, times nor texts all have 0."""
    kind = df.schema[id].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(id).cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        ends = df.agg(F.min(id).alias("low"), F.max(id).alias("high")).first()
        shared = len(os.path.commonprefix([ends["low"] or "", ends["high"] or ""]).encode())
        behind = f"hex(substring(encode(`{id}`, 'utf-8'), {shared + 1}, {ID_BYTES}))"
        return F.expr(f"cast(conv(rpad({behind}, {2 * ID_BYTES}, '0'), 16, 10) as double)")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.col(id).cast("double")
    return F.when(F.col(id).isNotNull(), F.lit(0.0))


def slices(df: DataFrame, id: str, tie: str) -> DataFrame:
    """Adds `_slice` and `_part`: rows cut by ranges of the id into slices of about SLICE_ROWS rows. Null ids come below all
    others. Bounds are quantiles: at most MOST_SLICES numbers, so slices grow with the table beyond that. A slice that holds
    far more rows than that, as one id has many (null ids, say), is cut into parts: that id's rows by ranges of their tie, a
    64-bit hash, behind part 0, which has the others."""
    at = F.coalesce(id_code(df, id), F.lit(float("-inf")))
    rows = df.count()
    wanted = min(MOST_SLICES, rows // SLICE_ROWS)
    bounds: list[float] = []
    if wanted > 1:
        shares = F.array(*[F.lit(i / wanted) for i in range(1, wanted)])
        found = df.agg(F.percentile_approx(at, shares, F.lit(20 * wanted)).alias("q")).first()["q"]
        bounds = sorted({b for b in found if float("-inf") < b < float("inf")})
    if not bounds:
        cut = df.withColumn("_slice", F.lit(0))
    else:
        edges = [float("-inf"), *bounds, float("inf")]
        own = Bucketizer(splits=edges, inputCol="_at", outputCol="_slice", handleInvalid="keep")
        cut = own.transform(df.withColumn("_at", at)).drop("_at").withColumn("_slice", F.col("_slice").cast("int"))
    if wanted < 2:
        return cut.withColumn("_part", F.lit(0))
    share = 4 * rows // wanted
    lowest = F.min(F.struct(F.col(id).isNotNull().alias("known"), F.col(id).alias("id"))).alias("low")
    full = cut.groupBy("_slice").agg(F.count("*").alias("rows"), lowest).where(F.col("rows") > share)
    full = full.select("_slice", F.col("low.id").alias("_low"), F.ceil(F.col("rows") / SLICE_ROWS).alias("_parts"))
    # At most one row for every slice.
    wide = cut.join(F.broadcast(full), "_slice", "left")
    part = F.floor((F.col(tie) / 2.0**64 + 0.5) * F.col("_parts")).cast("int") + 1
    hot = F.col("_parts").isNotNull() & F.col(id).eqNullSafe(F.col("_low"))
    return wide.withColumn("_part", F.when(hot, part).otherwise(0)).drop("_low", "_parts")


def with_next(
    df: DataFrame, id: str, columns: list[str], ties: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda x: x
) -> DataFrame:
    """Adds next_<column>: the values of the row with the next smaller id (ties by `ties`, the first of which is a hash);
    after the last comes the first.

    Rows are ordered within slices of the id range; the first row of every slice is copied to the slice above it as well,
    so no slice has to see another and no window holds more than a slice. `prepare` adds columns where the rows have been
    moved to, so what it adds is not moved.
    """
    cut = slices(df, id, ties[0])
    order = [F.col(id).desc_nulls_last(), *[F.col(t) for t in ties]]
    own = ["_slice", "_part"]
    tops = cut.groupBy(*own).agg(F.max(F.struct(F.col(id).isNotNull().alias("known"), F.col(id).alias("id"))).alias("top"))
    # In reading order: from the highest ids down, parts of a slice upwards.
    held = sorted(((r["_slice"], r["_part"], r["top"]["id"]) for r in tops.collect()), key=lambda h: (-h[0], h[1]))
    above = [(*low, *high[:2]) for high, low in zip([held[-1], *held], held, strict=False)] if held else []
    top = df.sparkSession.createDataFrame(
        above, f"_slice int, _part int, _top {dict(df.dtypes)[id]}, _above int, _above_part int"
    )
    candidates = cut.join(F.broadcast(top), own).where(F.col(id).eqNullSafe(F.col("_top")))
    first = F.row_number().over(Window.partitionBy(*own).orderBy(*order)) == 1
    copies = candidates.withColumn("_first", first).where("_first").withColumns({"_slice": F.col("_above"), "_part": F.col("_above_part")})
    rows = cut.withColumn("_copy", F.lit(0)).unionByName(copies.select(*cut.columns, F.lit(1).alias("_copy")))
    window = Window.partitionBy(*own).orderBy("_copy", *order)
    ahead = prepare(rows.repartition(*own)).withColumns({f"next_{c}": F.lead(c).over(window) for c in columns})
    return ahead.where("_copy = 0").drop("_copy", *own)


def fingerprints(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `df`: `id`, text, n_chars and neighbours (array of hashes, the fingerprint). Null texts count as empty and
    have none; null ids stay, repeated rows each give a row, an empty table gives none; other columns are not read. No
    shuffle."""
    rows = _texts(df, id, text).withColumn("_plain", plain("text")).withColumn("_anchors", F.expr(anchors("_plain")))
    return rows.select(F.col("_id").alias(id), "text", "n_chars", F.expr(neighbours("_anchors")).alias("neighbours"))


def _texts(df: DataFrame, id: str, text: str) -> DataFrame:
    rows = df.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("bigint"))


def _with_links(df: DataFrame) -> DataFrame:
    return df.withColumn("_plain", plain("text")).withColumn("own", F.expr(links(anchors("_plain")))).drop("_plain")


def spliced(df: DataFrame, k: int = K) -> DataFrame:
    """Adds `edited`: the neighbour hashes of `_front` and `_back` (plain texts, `_gap` in between) pasted together, from
    `own` and `next_own`, the links of texts that they begin, and their `own_hashes` and `next_own_hashes`; and `_rest`,
    those of them behind the ones from `own`. A link is free of place, so those between anchors inside either part stay. Read
    are the seam, from the last anchor of the front to the end of the first one of the back, and the last anchor of all,
    which has itself alone."""
    # The bound is held by a lambda of its own: as a column it could be put into the filter, and counted for every link.
    bound = f"shiftleft(cast(greatest(length(%s) - {k - 1}, 0) as bigint), {BITS})"
    below = f"size(transform(array({bound}), b -> filter(%s, x -> x < b))[0])"
    inside = {"_heads": below % ("_front", "own"), "_tails": below % ("_back", "next_own")}
    place = f"cast(shiftright(get(%s), {BITS}) as int)"
    ends = {
        "_from": f"coalesce({place % 'own, _heads - 1'}, 0)",
        "_until": f"if(_tails = 0, length(_back), {place % 'next_own, 0'} + {k})",
        "_last": f"coalesce({place % 'next_own, _tails - 1'}, 0)",
    }
    read = {
        "_seam": "concat(substring(_front, _from + 1), _gap, left(_back, _until))",
        "_end": f"if(_tails = 0, '', substring(_back, _last + 1, {k}))",
    }
    found = {c: hashes(links(anchors(c, k))) for c in read}
    rest = """concat(
        if(_tails = 0, _seam, slice(_seam, 1, greatest(size(_seam) - 1, 0))),
        slice(next_own_hashes, 1, greatest(_tails - 1, 0)),
        _end)"""
    for columns in (inside, ends, read, found, {"_rest": rest}, {"edited": "concat(slice(own_hashes, 1, greatest(_heads - 1, 0)), _rest)"}):
        df = df.withColumns({c: F.expr(e) for c, e in columns.items()})
    return df


def edit_report(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `df`: `id`, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last third replaced by the start of the next one (descending id, ties by a hash of
    the text, then the text; the first after the last). near_edited is the likeness of both fingerprints, near_next that of
    the fingerprints of neighbours. Null and empty texts have the empty fingerprint, which is like itself (1) and unlike all
    others (0); texts under 10 characters have one hash. Null ids come last, whatever their number; equal ids and repeated
    rows each give a row; an empty table gives none. Ids may be numbers, times or texts; other columns are not read.
    """
    rows = _texts(df, id, text).withColumn("_tie", F.xxhash64("text"))
    rows = with_next(rows, "_id", ["text", "own"], ["_tie", "text"], _with_links)
    third = "int(n_chars div 3)"
    rows = rows.withColumn("_first", F.expr(f"left(text, int(n_chars) - {third})")).withColumn("_then", F.expr(f"left(next_text, {third})"))
    rows = rows.withColumns({"_front": plain("_first"), "_back": plain("_then"), "edited_sha256": F.expr("sha2(concat(_first, _then), 256)")})
    blank = r"(right(_first, 1) RLIKE r'[\x20\x09-\x0D]' OR left(_then, 1) RLIKE r'[\x20\x09-\x0D]')"
    rows = rows.withColumn("_gap", F.expr(f"if(_front <> '' AND _back <> '' AND {blank}, ' ', '')"))
    rows = rows.withColumns({f"{c}_hashes": F.expr(hashes(c)) for c in ("own", "next_own")})
    rows = spliced(rows)
    distinct = {"own": "own_hashes", "next_own": "next_own_hashes", "edited": "edited"}
    rows = rows.select("_id", "n_chars", "edited_sha256", *[F.array_distinct(v).alias(c) for c, v in distinct.items()], "_rest")
    # All hashes of the edited text but those of the rest are own ones.
    common_edited = (F.size("edited") - F.size(F.array_except("_rest", "own"))).alias("_common_edited")
    common = [common_edited, F.size(F.array_intersect("own", "next_own")).alias("_common_next_own")]
    rows = rows.select("*", *common)
    return rows.select(
        F.col("_id").alias(id),
        "n_chars",
        "edited_sha256",
        written("own").alias("fingerprint"),
        written("edited").alias("edited_fingerprint"),
        likeness("own", "edited", F.col("_common_edited")).alias("near_edited"),
        likeness("own", "next_own", F.col("_common_next_own")).alias("near_next"),
    )
