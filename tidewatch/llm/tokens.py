"""Token counts: pre-token lengths from a broadcast table and worker caches, no shuffle of pre-tokens.

The first tier is the tokenizer's own vocabulary, whose entries are the pieces that were frequent when it was made: a
pre-token that is an entry has a known length. Its size is that of the vocabulary, whatever the corpus. Pre-tokens that
miss it are encoded by the tokenizer library's model once per worker and kept in a bounded cache.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm.batches import map_texts
from tidewatch.llm.pretokens import cut, is_plain

#: Pre-tokens kept by one worker before its cache starts anew.
CACHE_ENTRIES = 400_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, back to bytes: printable bytes stand for themselves, the rest
    follow from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def frequent_lengths(tokenizer: Tokenizer) -> dict[str, int]:
    """Number of tokens of every vocabulary entry that is text, as the library encodes it."""
    back, entries = byte_alphabet(), []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        try:
            entries.append(bytes(back[c] for c in entry).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    entries = [e for e in entries if is_plain(e)]
    pieces = cut(entries, words=False)
    # Only entries that are one pre-token can be looked up.
    whole = np.bincount(pieces.owner, minlength=len(entries)) == 1
    entries = [e for e, w in zip(entries, whole, strict=True) if w]
    model, stand_in = tokenizer.model, stand_ins()
    return {e: len(model.tokenize(as_bytes(e, stand_in))) for e in entries}


def stand_ins() -> dict[int, str]:
    return {b: c for c, b in byte_alphabet().items()}


def as_bytes(piece: str, stand_in: dict[int, str]) -> str:
    """A pre-token as the library's model reads it: one stand-in character per byte."""
    return piece.encode().decode("latin-1").translate(stand_in)


def _lengths(tokenizer: Tokenizer, texts: list[str]) -> list[int]:
    return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Counter:
    """Counts the tokens of texts; made once per task."""

    def __init__(self, tokenizer: Tokenizer, table: dict[str, int], entries: int = CACHE_ENTRIES):
        self.tokenizer, self.table, self.entries = tokenizer, table, entries
        self.cache: dict[str, int] = {}
        self.model, self.stand_in = tokenizer.model, stand_ins()
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def __call__(self, texts: list[str | None]) -> list[int]:
        out = np.zeros(len(texts), np.int64)
        easy, hard = [], []
        for i, t in enumerate(texts):
            if t:
                (easy if is_plain(t) and not any(s in t for s in self.special) else hard).append(i)
        if easy:
            pieces = cut([texts[i] for i in easy], words=False)
            known = self._known(pieces.strings())
            out[easy] = np.bincount(pieces.owner, known[pieces.number], len(easy)).astype(np.int64)
        if hard:
            out[hard] = _lengths(self.tokenizer, [texts[i] for i in hard])
        return out.tolist()

    def _known(self, strings: list[str]) -> np.ndarray:
        table, cache = self.table, self.cache
        missing = [s for s in strings if s not in table and s not in cache]
        if len(cache) + len(missing) > self.entries:
            cache.clear()
            missing = [s for s in strings if s not in table]
        encode, stand_in = self.model.tokenize, self.stand_in
        for s in missing:
            cache[s] = len(encode(as_bytes(s, stand_in)))
        return np.array([table[s] if s in table else cache[s] for s in strings], np.int64)


def tokenizer_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def count_tokens(df: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """One row per row of `df`: `id`, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Counts are those of the library's `encode(text, add_special_tokens=False)` without truncation or padding; special
    strings inside a text count as the library takes them. A null text counts as empty; a null id stays; repeated rows
    each give a row; an empty table gives none; other columns are not read. `tokenizer_path` is read on the driver; its
    content and the table of frequent lengths, both bounded by the vocabulary, are broadcast.
    """
    source = tokenizer_text(tokenizer_path)
    tokenizer = Tokenizer.from_str(source)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    shared = df.sparkSession.sparkContext.broadcast((tokenizer.to_str(), frequent_lengths(tokenizer)))

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        definition, table = shared.value
        count = Counter(Tokenizer.from_str(definition), table)
        for part in parts:
            yield {id: part[id], "n_bytes": part["n_bytes"], "n_tokens": count(part[text])}

    kind = dict(df.dtypes)[id]
    bytes_of = F.coalesce(F.octet_length(text).cast("bigint"), F.lit(0).cast("bigint"))
    counted = map_texts(
        df.select(id, text, bytes_of.alias("n_bytes")), run, f"`{id}` {kind}, n_bytes bigint, n_tokens bigint", text
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
