"""Packing: documents become full windows in which every source queue has its share of tokens.

Deficit round-robin: in every window a queue may send its quantum of tokens plus what an earlier window left it short of
(the fraction of a token that a quantum could not send). Because documents may be cut anywhere, what a queue has sent
after w windows is a closed expression, floor(quantum * w), up to its supply. So the place of every token follows from its
place in its queue alone, and that is a running total: it is counted in buckets of every queue, so a queue that holds most
of the corpus is spread over many tasks, and deficits carry over windows and partitions without any sequential state.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm.batches import map_texts
from tidewatch.llm.pretokens import cut, is_plain
from tidewatch.llm.tokens import CACHE_ENTRIES, as_bytes, stand_ins, tokenizer_text
from tidewatch.session import scratch_path

#: Tokens of a sequence, and sequences of one window of the round-robin.
SEQUENCE = 2048
WINDOW_SEQUENCES = 8
#: Sources share this many queues by hash, so the table of quanta has a bounded size for any number of sources.
QUEUES = 4096
#: Quanta count 1/65536 tokens; this is what makes deficits exact.
FINE = 16
#: Rows of a queue that are totalled in one bucket.
BUCKET_ROWS = 4000


class WordIds:
    """Token ids of texts under a lower-casing word tokenizer, each distinct word encoded once per worker."""

    def __init__(self, tokenizer: Tokenizer, last: int, entries: int = CACHE_ENTRIES):
        self.tokenizer, self.entries = tokenizer, entries
        self.model, self.stand_in = tokenizer.model, stand_ins()
        top = max(tokenizer.get_vocab(with_added_tokens=True).values())
        self.kind = np.dtype("<u2" if max(top, last) < 1 << 16 else "<u4")
        self.tail = np.array([last], self.kind).tobytes()
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text with the closing id, as little-endian integers of `kind`."""
        out: list[bytes] = [self.tail] * len(texts)
        easy, hard = [], []
        for i, t in enumerate(texts):
            if t:
                (easy if is_plain(t) and not any(s in t for s in self.special) else hard).append(i)
        if easy:
            for i, ids in zip(easy, self._plain([texts[i].lower() for i in easy]), strict=True):
                out[i] = ids + self.tail
        if hard:
            found = self.tokenizer.encode_batch_fast([texts[i] for i in hard], add_special_tokens=False)
            for i, e in zip(hard, found, strict=True):
                out[i] = np.array(e.ids, self.kind).tobytes() + self.tail
        return out

    def _plain(self, texts: list[str]) -> list[bytes]:
        pieces = cut(texts, words=True)
        words = self._known(pieces.strings())
        size = np.array([len(w) for w in words], np.int64) // self.kind.itemsize
        flat = np.frombuffer(b"".join(words), self.kind)
        offset = np.cumsum(size) - size
        length = size[pieces.number]
        edge = np.cumsum(length) - length
        ids = flat[np.arange(int(length.sum())) + np.repeat(offset[pieces.number] - edge, length)]
        ends = np.cumsum(np.bincount(pieces.owner, length, len(texts)).astype(np.int64)).tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]

    def _known(self, words: list[str]) -> list[bytes]:
        cache, encode, stand_in, kind = self.cache, self.model.tokenize, self.stand_in, self.kind
        if len(cache) + len(words) > self.entries:
            cache.clear()
        for w in words:
            if w not in cache:
                cache[w] = np.array([t.id for t in encode(as_bytes(w, stand_in))], kind).tobytes()
        return [cache[w] for w in words]


def encode_documents(df: DataFrame, tokenizer_path: str, last: int, id: str, text: str, source: str) -> DataFrame:
    """row, `id`, queue, n (ids with the closing one) and ids, written once in the shared folder and read back."""
    tokenizer = Tokenizer.from_str(tokenizer_text(tokenizer_path))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    spark = df.sparkSession
    definition = spark.sparkContext.broadcast(tokenizer.to_str())

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        encode = WordIds(Tokenizer.from_str(definition.value), last)
        for part in parts:
            ids = encode(part.pop(text))
            yield part | {"ids": ids, "n": [len(i) // encode.kind.itemsize for i in ids]}

    queue = F.pmod(F.xxhash64(F.coalesce(F.col(source).cast("string"), F.lit(""))), F.lit(QUEUES)).cast("int")
    kind = dict(df.dtypes)[id]
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).alias("doc"), queue.alias("queue"), F.col(text).alias(text)
    )
    out = map_texts(rows, run, f"row bigint, doc {kind}, queue int, n bigint, ids binary", text)
    path = scratch_path(spark, "packing-ids")
    out.write.parquet(path)
    return spark.read.parquet(path)


def queue_places(encoded: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """row and `before`: the tokens of its queue that stand before it. Queues are read by bucket, then by row."""
    rows = encoded.select("row", "queue", "n")
    buckets = max(1, -(-rows.count() // bucket_rows))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    sums = rows.groupBy("queue", "bucket").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("queue", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("queue", "bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(sums, ["queue", "bucket"])
        .select("row", (F.col("base") + F.col("inside")).alias("before"))
    )


class Schedule:
    """Where the tokens of every queue go: supply, quantum (in 1/65536 tokens a window) and first window of the queues in use."""

    def __init__(self, supply: dict[int, int], shares: dict[int, float], window: int):
        self.queues = sorted(supply)
        self.at = {q: i for i, q in enumerate(self.queues)}
        self.supply = np.array([supply[q] for q in self.queues], np.int64)
        share = np.array([max(shares.get(q, 0.0), 0.0) for q in self.queues])
        named = share > 0
        # Queues without a share wait until the others are empty, and then share windows as their tokens do.
        share = np.where(named, share / max(share[named].sum(), 1e-300), 0.0)
        rest = np.where(named, 0, self.supply)
        share = np.where(named, share, rest / max(int(rest.sum()), 1))
        self.quantum = np.maximum(1, np.rint(share * window * (1 << FINE))).astype(np.int64)
        windows = -(-(self.supply << FINE) // self.quantum)
        self.begin = np.where(named, 0, int(windows[named].max(initial=0))).astype(np.int64)
        self.known: dict[int, np.ndarray] = {}

    def sent(self, window: int) -> np.ndarray:
        """Tokens that every queue has sent before this window."""
        return np.minimum(self.supply, (self.quantum * np.maximum(window - self.begin, 0)) >> FINE)

    def origin(self, window: int) -> np.ndarray:
        """For every queue, the place in the packed stream of its first token of this window."""
        if window not in self.known:
            if len(self.known) > 4096:
                self.known.clear()
            before, after = self.sent(window), self.sent(window + 1)
            own = after - before
            self.known[window] = before.sum() + np.cumsum(own) - own
        return self.known[window]

    def pieces(self, queue: int, before: int, n: int, sequence: int) -> Iterator[tuple[int, int, int]]:
        """(start in the document, length, place in the stream) of a document of n tokens."""
        i = self.at[queue]
        quantum, supply, begin = int(self.quantum[i]), int(self.supply[i]), int(self.begin[i])
        at, stop = before, before + n
        while at < stop:
            window = -(-((at + 1) << FINE) // quantum) - 1
            first = min(supply, (quantum * window) >> FINE)
            until = min(stop, supply, (quantum * (window + 1)) >> FINE)
            place = int(self.origin(begin + window)[i]) + at - first
            while at < until:
                length = min(until - at, sequence - place % sequence)
                yield at - before, length, place
                at, place = at + length, place + length


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shares: dict[str, float] | None = None,
    last: int = 1,
    sequence: int = SEQUENCE,
    window_sequences: int = WINDOW_SEQUENCES,
) -> DataFrame:
    """One row per piece: `id`, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `shares` gives the target proportion of tokens per source (missing ones get none until the named ones run out); without
    it, targets are the proportions of the corpus, so all queues end together. When a queue is exhausted the windows that
    follow are made of the others. Sequences are full but for the last. A null text counts as empty and takes the closing id
    only; a null source is a queue of its own; repeated rows and equal or null ids are packed each by itself; an empty table
    gives no rows; other columns are not read. Work tables lie in the shared folder.
    """
    spark = df.sparkSession
    encoded = encode_documents(df, tokenizer_path, last, id, text, source)
    supply = {r["queue"]: r["held"] for r in encoded.groupBy("queue").agg(F.sum("n").alias("held")).collect()}
    if shares is None:
        wanted = {q: float(n) for q, n in supply.items()}
    else:
        names = spark.createDataFrame([(k, float(v)) for k, v in shares.items()], "name string, share double")
        queue = F.pmod(F.xxhash64("name"), F.lit(QUEUES)).cast("int")
        wanted = {r["queue"]: r["share"] for r in names.groupBy(queue.alias("queue")).agg(F.sum("share").alias("share")).collect()}
    schedule = spark.sparkContext.broadcast(Schedule(supply, wanted, sequence * window_sequences))
    tokenizer = Tokenizer.from_str(tokenizer_text(tokenizer_path))
    wide = WordIds(tokenizer, last).kind
    kind = dict(df.dtypes)[id]
    columns = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = f"`{id}` {kind}, " + ", ".join(f"{c} bigint" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = schedule.value
        for batch in batches:
            docs, cells = batch.column("doc"), [[] for _ in columns]
            of: list[int] = []
            fields = (batch.column(c).to_pylist() for c in ("queue", "before", "n", "ids"))
            for r, (queue, before, n, ids) in enumerate(zip(*fields, strict=True)):
                numbers = np.frombuffer(ids, wide).astype("<u4")
                for start, length, place in plan.pieces(queue, before, n, sequence):
                    crc = zlib.crc32(numbers[start : start + length].tobytes())
                    for cell, v in zip(cells, (start, length, crc, n, place // sequence, place % sequence), strict=True):
                        cell.append(v)
                    of.append(r)
            rows = docs.take(pa.array(of, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows, *[pa.array(c, pa.int64()) for c in cells]], [id, *columns])

    placed = encoded.join(queue_places(encoded), "row").select("doc", "queue", "before", "n", "ids")
    return placed.mapInArrow(run, schema)
