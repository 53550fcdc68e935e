"""Spelling variants: words of a corpus one edit apart, grouped under the more frequent form.

Counting is a map with sums per task before the only shuffle of words. Of two words one edit apart, one half of either is
untouched: the left half (its first length // 2 letters) begins the other, or the right half ends it. So every word goes as
a query to one block for each of its halves, and as a text to the blocks where words that are a letter shorter, as long, or
a letter longer look for it. A block indexes its texts (`fmindex`) and matches the half of each query exactly, then the rest
with one error. What comes out is one row per query and block: how many words are near, and the most frequent one.

A half that more than BLOCK_WORDS texts share is cut: its texts are dealt over several blocks, and its queries visit each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.batches import map_texts
from tidewatch.llm.fmindex import Vocabulary
from tidewatch.session import scratch_path

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Texts of one index.
BLOCK_WORDS = 8_000
#: Most tasks that blocks are dealt over.
MOST_TASKS = 20_000
#: Distinct words that a task gathers before it puts their counts out.
HELD_WORDS = 300_000
#: Every so-many-th run loses a letter.
THINNED = 97
_RUNS = re.compile(rb"[a-z\xc0-\xff]+")


def runs(text: str) -> Counter[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lowered, with their numbers: one byte per letter."""
    return Counter(_RUNS.findall(text.encode("latin-1", "replace").lower()))


def thinned(run: bytes, start: int) -> bytes:
    """A run, less one letter when 97 divides the checksum of `<doc_id>:<run>`, of which `start` is that up to the colon."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % THINNED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the words of at least 5 letters and 3 occurrences in all texts. A null text has no words; a null id is read
    as the empty text."""

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        held: Counter[bytes] = Counter()
        for part in parts:
            for key, t in zip(part["key"], part[text], strict=True):
                if t:
                    start = crc32(f"{key}:".encode())
                    for r, n in runs(t).items():
                        if len(r) >= LEAST_LENGTH:
                            held[thinned(r, start)] += n
            if len(held) > HELD_WORDS:
                yield _counted(held)
                held = Counter()
        yield _counted(held)

    key = F.coalesce(F.col(id).cast("string"), F.lit("")).alias("key")
    partial = map_texts(docs.select(key, F.col(text)), run, "word string, n bigint", text)
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _counted(held: Counter[bytes]) -> dict[str, list]:
    kept = {w: n for w, n in held.items() if len(w) >= LEAST_LENGTH}
    return {"word": [w.decode("latin-1") for w in kept], "n": list(kept.values())}


def _half(length: str, left: bool) -> str:
    """SQL of the half of a word by which a query of some length looks for it, with that half's own length in front."""
    cut = f"({length}) div 2"
    if left:
        return f"concat('<', {cut}, ':', substring(word, 1, int({cut})))"
    rest = f"(({length}) - {cut})"
    return f"concat('>', {rest}, ':', right(word, int({rest})))"


def entries(words: DataFrame) -> DataFrame:
    """word, n, half, asks: a row for every half under which a word is found, and whether it looks there itself."""
    size = "char_length(word)"
    halves = ", ".join(
        f"named_struct('half', {_half(f'{size} + {more}', left)}, 'asks', {'true' if more == 0 else 'false'})"
        for left in (True, False)
        for more in (0, -1, 1)
    )
    rows = words.select("word", "n", F.explode(F.expr(f"array({halves})")).alias("at"))
    return rows.groupBy("word", "n", F.col("at.half").alias("half")).agg(F.max("at.asks").alias("asks"))


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: of the words that have others one edit away, how many, and the most frequent of them (of
    equals the least in code-point order). `words` has distinct words with their counts n."""
    spark = words.sparkSession
    path = scratch_path(spark, "spelling-halves")
    entries(words).write.parquet(path)
    rows = spark.read.parquet(path)
    total = rows.count()
    blocks = max(1, -(-total // BLOCK_WORDS))
    hot = rows.groupBy("half").agg(F.count("*").alias("texts")).where(F.col("texts") > BLOCK_WORDS)
    hot = hot.select("half", F.ceil(F.col("texts") / BLOCK_WORDS).cast("int").alias("cuts"))
    rows = rows.join(hot, "half", "left")
    plain = F.col("cuts").isNull()
    rows = rows.withColumn("mine", F.when(plain, 0).otherwise(F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int")))
    everywhere = F.when(plain | ~F.col("asks"), F.array("mine")).otherwise(F.sequence(F.lit(0), F.col("cuts") - 1))
    rows = rows.withColumn("cut", F.explode(everywhere))
    # Halves that were cut have blocks of their own; the others share blocks by hash.
    block = F.when(plain, F.pmod(F.xxhash64("half"), F.lit(blocks)).cast("string")).otherwise(F.col("half"))
    dealt = rows.select(
        block.alias("block"), "cut", "word", "n", "half", "asks", (F.col("cut") == F.col("mine")).alias("text")
    )
    # Blocks are small but take work: dealt over so many tasks, they are not put together again by their bytes.
    dealt = dealt.repartition(min(blocks, MOST_TASKS), "block", "cut")
    found = dealt.groupBy("block", "cut").applyInArrow(_meet, "word string, near bigint, best_n bigint, best string")
    merged = found.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("first")
    )
    return merged.select("word", "n_near", (-F.col("first.rank")).alias("best_n"), F.col("first.best").alias("best"))


def _meet(table: pa.Table) -> pa.Table:
    """The near words of the queries of one block among its texts."""
    word, n, half = table["word"].to_pylist(), table["n"].to_numpy(), table["half"].to_pylist()
    asks, text = table["asks"].to_pylist(), table["text"].to_pylist()
    texts = dict(sorted((w, c) for w, c, t in zip(word, n.tolist(), text, strict=True) if t))
    index, counts = Vocabulary(list(texts)), np.array(list(texts.values()), np.int64)
    query, near = [], []
    for left in (True, False):
        own = [w for w, h, a in zip(word, half, asks, strict=True) if a and (h[0] == "<") == left]
        if not own or not texts:
            continue
        q, w = index.within_one(own, left)
        if not left:
            # Words with the same left half are found from there.
            fresh = [not index.words[y].startswith(own[x][: len(own[x]) // 2]) for x, y in zip(q.tolist(), w.tolist(), strict=True)]
            q, w = q[fresh], w[fresh]
        query += [own[i] for i in q.tolist()]
        near.append(w)
    w = np.concatenate([np.zeros(0, np.int64), *near])
    number: dict[str, int] = {}
    who = np.array([number.setdefault(q, len(number)) for q in query], np.int64)
    names = list(number)
    # The first of every query: most frequent, then least in order, which is that of the index.
    order = np.lexsort((w, -counts[w], who))
    first = order[np.searchsorted(who[order], np.arange(len(names)))]
    return pa.table(
        {
            "word": pa.array(names, pa.string()),
            "near": np.bincount(who, minlength=len(names)).astype(np.int64),
            "best_n": counts[w[first]],
            "best": pa.array([index.words[i] for i in w[first].tolist()], pa.string()),
        }
    )


def roots_of(forms: DataFrame) -> DataFrame:
    """word, root: the last word that forms lead to. Every round doubles the way, so chains take the logarithm of their
    length; counts at least double from word to form, so there are no circles."""
    spark = forms.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "spelling-roots")
        df.write.parquet(path)
        return spark.read.parquet(path)

    ways = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        end = F.coalesce("further", "root").alias("root")
        longer = stored(ways.join(onward, "root", "left").select("word", end, F.col("further").isNotNull().alias("went")))
        ways = longer.select("word", "root")
        if not longer.where("went").limit(1).count():
            return ways


def spelling_variants(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word of the corpus: word, form, root, n, n_near, form_n.

    Words are the lowered runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of all texts, of which every 97th by checksum
    of id and run lost a letter, with at least 5 letters and 3 occurrences n. n_near counts the words exactly one inserted,
    deleted or replaced letter away; form is the most frequent of them (ties: least in code-point order) if it is at least
    twice as frequent, with its count form_n; root is where forms lead to, the word itself without one. Null and empty texts
    have no words; a null id is read as the empty text; repeated rows count each time; an empty table gives no rows; other
    columns are not read. Words of any length take part. Work tables lie in the shared folder.
    """
    spark = docs.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, f"spelling-{label}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    words = stored(count_words(docs, id, text), "words")
    near = stored(near_words(words), "near")
    better = F.col("best_n") >= 2 * F.col("n")
    named = words.join(near, "word", "left").select(
        "word",
        F.when(better, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(better, F.col("best_n")).alias("form_n"),
    )
    named = stored(named, "forms")
    roots = roots_of(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
