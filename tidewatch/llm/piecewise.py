"""Encoding and decoding with merge-type SentencePiece models, by a table of the last token of every prefix.

Merging joins, again and again, the neighbours whose union has the best score (leftmost of equals). Whether a merge ever
crosses the border between two tokens depends on these two alone, so a row of tokens is what a text merges to if and only
if every token merges to itself and every pair of neighbours stays apart. Hence the tokens of a prefix are those of a
shorter prefix and one more: an automaton reports the pieces that end at a place, and exactly one of them (or the single
character there) is compatible with the last token of the prefix that it leaves. The table is filled in reading order, and
ids are recovered backwards.

No piece has a blank behind another character in the models this is meant for. Then no token crosses from a word into the
blanks that follow, and equal words have equal tokens: every worker process keeps the ids of words it has met.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewatch.llm.batches import cuts
from tidewatch.llm.batches import pieces as text_pieces

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
#: Longer words are encoded one by one.
SHORT = 64
#: Words, and characters of words, that one worker keeps before its cache starts anew.
CACHE_WORDS = 200_000
CACHE_CHARS = 8_000_000
#: Compatibility answers that one worker keeps by name, about 130 bytes each.
CACHE_PAIRS = 50_000
#: Tokens of a pair, and a token with its length, are packed into one number each.
PAIR_BITS = 32
LENGTH_BITS = 16
LENGTH_MASK = (1 << LENGTH_BITS) - 1
#: Characters that the automaton in arrays has steps for.
COLUMNS = 250
#: Places (as a power of 2) for the answers of the latest pairs, 9 bytes each.
SLOT_BITS = 20
#: Bytes of text that are turned into words at a time, whole texts each.
CUT_BYTES = 750_000
#: Ids gathered into one output batch.
BATCH_IDS = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """What encoding needs of a model: the text, score and kind of every id, in order of ids."""

    texts: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    unknown: int
    end: int
    unknown_surface: str


def read_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a model file. Other kinds of models, and text rules that change more than blanks, are refused."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rules, trained = model.normalizer_spec, model.trainer_spec
    plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
    if trained.model_type != 2 or trained.treat_whitespace_as_suffix or not trained.byte_fallback:
        raise ValueError("Only merge-type models with byte fallback and blanks in front are supported")
    kinds = tuple(p.type for p in model.pieces)
    if not plain or rules.precompiled_charsmap or model.denormalizer_spec.precompiled_charsmap:
        raise ValueError("Only models that leave text as it is, but for blanks and one in front, are supported")
    if {USER_DEFINED, UNUSED} & set(kinds):
        raise ValueError("Models with user-defined or unused pieces are not supported")
    texts = tuple(p.piece for p in model.pieces)
    return Vocabulary(
        texts, tuple(p.score for p in model.pieces), kinds, kinds.index(UNKNOWN), trained.eos_id, trained.unk_surface
    )


class Encoder:
    """Encodes words with the prefix table."""

    def __init__(self, vocabulary: Vocabulary):
        kinds = vocabulary.kinds
        self.score = {t: s for t, s, k in zip(vocabulary.texts, vocabulary.scores, kinds, strict=True) if k == NORMAL}
        self.id = {t: i for i, (t, k) in enumerate(zip(vocabulary.texts, kinds, strict=True)) if k == NORMAL}
        self.bytes = {int(t[1:-1], 16): i for i, (t, k) in enumerate(zip(vocabulary.texts, kinds, strict=True)) if k == BYTE}
        self.texts = vocabulary.texts
        self.automaton = ahocorasick.Automaton()
        self.merges: dict[int, tuple[list[tuple[float, str]], list[tuple[float, str]]]] = {}
        for text, i in self.id.items():
            if len(text) > 1 and (history := self._history(text)) is not None:
                self.merges[i] = history
                self.automaton.add_word(text, (i << LENGTH_BITS) + len(text))
        self.automaton.make_automaton()
        # What a token takes of a text; characters, at the end, take one.
        self.lengths = np.array([*(len(t) for t in vocabulary.texts), 1], np.int64)
        self._steps()
        self.splits = not any(BLANK in t.lstrip(BLANK) for t in self.id)
        self.pairs: dict[int, bool] = {}
        self.asked, self.answered = np.full(1 << SLOT_BITS, -1, np.int64), np.zeros(1 << SLOT_BITS, bool)

    def _history(self, text: str) -> tuple[list[tuple[float, str]], list[tuple[float, str]]] | None:
        """The merges that make a piece, each with its score and the first and the last symbol before it; None when the
        merging of the piece ends elsewhere."""
        symbols, first, last = list(text), [], []
        while len(symbols) > 1:
            best = max(
                ((self.score[x + y], -i) for i, (x, y) in enumerate(zip(symbols, symbols[1:], strict=False)) if x + y in self.score),
                default=None,
            )
            if best is None:
                return None
            first.append((best[0], symbols[0]))
            last.append((best[0], symbols[-1]))
            at = -best[1]
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return first, last

    def _text(self, token: int) -> str:
        return self.texts[token] if token >= 0 else chr(-token - 1)

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border between two tokens. Tokens are ids, or -1 - code point for characters.

        Both tokens go through their own merges, best score first; the union of the symbols that face each other at the
        border wins when it has a better score than what is next on the left, or one as good as what is next on the right.
        """
        key = (left << PAIR_BITS) + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        before = self.merges[left][1] if left in self.merges else []
        after = self.merges[right][0] if right in self.merges else []
        i, j, score, none = 0, 0, self.score, (float("-inf"), "")
        while True:
            on_left, on_right = before[i] if i < len(before) else none, after[j] if j < len(after) else none
            a = on_left[1] or self._text(left)
            b = on_right[1] or self._text(right)
            crossing = score.get(a + b)
            if crossing is not None and crossing > on_left[0] and crossing >= on_right[0]:
                return False
            if i == len(before) and j == len(after):
                return True
            if j == len(after) or (i < len(before) and on_left[0] >= on_right[0]):
                i += 1
            else:
                j += 1

    def encode(self, text: str) -> array:
        """Ids of one text whose blanks are marks already."""
        last = array("i", [0])
        last.extend(-1 - ord(c) for c in text)
        compatible = self.compatible
        for end, found in self.automaton.iter(text):
            token, length = found >> LENGTH_BITS, found & LENGTH_MASK
            start = end + 1 - length
            if last[end + 1] < 0 and (not start or compatible(last[start], token)):
                last[end + 1] = token
        ids, at = array("i"), len(text)
        while at:
            token = last[at]
            if token >= 0:
                ids.append(token)
                at -= len(self.texts[token])
            else:
                at -= 1
                ids.extend(reversed(self.ids_of_character(-token - 1)))
        ids.reverse()
        return ids

    def ids_of_character(self, code: int) -> list[int]:
        c = chr(code)
        return [self.id[c]] if c in self.id else [self.bytes[b] for b in c.encode()]

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, ids of all of them): the same table, filled for all texts place by place. They hold
        only characters that the steps of the automaton know (`can_step`)."""
        length = np.array([len(t) for t in texts], np.int64)
        end = np.cumsum(length)
        begin = end - length
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        column = self.column[np.minimum(codes, len(self.column) - 1)]
        # Entry i is the last token of the text up to its i-th character, over all texts in a row; openings are never read.
        last = np.append(0, -1 - codes.astype(np.int64))
        # Longest first, so that those still read are the first ones.
        order = np.argsort(-length, kind="stable")
        left = np.searchsorted(-length[order], -np.arange(1, int(length.max(initial=0)) + 1), "right")
        state = np.zeros(len(texts), np.int32)
        for p, n in enumerate(left.tolist()):
            here = begin[order[:n]] + p
            state = self.step[state[:n], column[here]]
            found, at = self.longest[state], here
            open = np.flatnonzero(found)
            while len(open):
                token, at = self.ends[found[open]], here[open]
                start = at + 1 - self.lengths[token]
                fits = start == at - p
                inner = np.flatnonzero(~fits)
                fits[inner] = self._all_apart(last[start[inner]], token[inner])
                last[at[fits] + 1] = token[fits]
                found[open] = self.shorter[found[open]]
                open = open[~fits]
                open = open[found[open] > 0]
        # Backwards, one token of every text at a time.
        at, active, rows = end.copy(), np.flatnonzero(length), []
        while len(active):
            here = last[at[active]]
            rows.append((active, here))
            at[active] -= self.lengths[np.maximum(here, -1)]
            active = active[at[active] > begin[active]]
        if not rows:
            return np.zeros(len(texts), np.int64), np.zeros(0, np.int32)
        step = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        owner, tokens = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        order = np.lexsort((-step, owner))
        owner, tokens = owner[order], tokens[order]
        return self._with_characters(owner, tokens, len(texts))

    def _all_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`compatible` for many pairs; the answers to the latest ones stand in a table by hash."""
        pair = (left << PAIR_BITS) + right
        slot = ((pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        new = np.flatnonzero(self.asked[slot] != pair)
        if len(new):
            fresh, which = np.unique(pair[new], return_inverse=True)
            sides = zip((fresh >> PAIR_BITS).tolist(), (fresh & ((1 << PAIR_BITS) - 1)).tolist(), strict=True)
            answer = np.array([self.compatible(a, b) for a, b in sides], bool)
            out = self.answered[slot]
            out[new] = answer[which]
            self.asked[slot[new]], self.answered[slot[new]] = pair[new], out[new]
            # Of several pairs with one slot the last one stays there, with its own answer.
            return out
        return self.answered[slot]

    def _steps(self) -> None:
        """The automaton as arrays: the step from every state by every column of characters, the longest piece that ends in
        a state, and the next shorter one that ends there too. Columns are the COLUMNS most frequent characters of pieces
        of several; the others of them cannot be stepped over, and all further characters lead to the start."""
        pieces = {self.texts[i]: i for i in self.merges}
        used = Counter(c for t in pieces for c in set(t))
        columns = {c: k + 1 for k, (c, _) in enumerate(used.most_common(COLUMNS))}
        self.rare = re.compile("[" + re.escape("".join(c for c in used if c not in columns)) + "]") if len(used) > COLUMNS else None
        self.column = np.zeros(max(map(ord, columns), default=0) + 2, np.int64)
        self.column[[ord(c) for c in columns]] = list(columns.values())
        kept = sorted((t for t in pieces if all(c in columns for c in t)), key=len)
        number = {"": 0}
        for depth in range(1, max(map(len, kept), default=0) + 1):
            for t in kept:
                if len(t) >= depth:
                    number.setdefault(t[:depth], len(number))
        self.step = np.zeros((len(number), COLUMNS + 1), np.uint16 if len(number) <= 1 << 16 else np.int32)
        self.longest = np.zeros(len(number), np.int64)
        self.ends, self.shorter = np.zeros(len(kept) + 1, np.int64), np.zeros(len(kept) + 1, np.int64)
        place = {t: k + 1 for k, t in enumerate(kept)}
        fall = np.zeros(len(number), np.int64)
        # States come by depth: those a state falls back to are shorter, and complete once the next depth begins.
        filled = 1
        for text, state in number.items():
            if not text:
                continue
            parent, c = number[text[:-1]], columns[text[-1]]
            while filled <= parent:
                self.step[filled] = self.step[fall[filled]]
                filled += 1
            fall[state] = self.step[fall[parent], c] if parent else 0
            self.step[parent, c] = state
            self.longest[state] = self.longest[fall[state]]
            if text in place:
                k = place[text]
                self.ends[k], self.shorter[k], self.longest[state] = pieces[text], self.longest[fall[state]], k
        for state in range(filled, len(number)):
            self.step[state] = self.step[fall[state]]

    def can_step(self, text: str) -> bool:
        return self.rare is None or self.rare.search(text) is None

    def _with_characters(self, owner: np.ndarray, tokens: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids for tokens of which the negative ones are characters."""
        single = np.flatnonzero(tokens < 0)
        if not len(single):
            return np.bincount(owner, minlength=n), tokens.astype(np.int32)
        codes, which = np.unique(tokens[single], return_inverse=True)
        own = [self.ids_of_character(-c - 1) for c in codes.tolist()]
        size = np.ones(len(tokens), np.int64)
        size[single] = np.array([len(o) for o in own])[which]
        out = np.repeat(tokens, size)
        inside = np.arange(len(out)) - np.repeat(np.cumsum(size) - size, size)
        held = np.zeros((len(own), 4), np.int64)
        for row, o in zip(held, own, strict=True):
            row[: len(o)] = o
        number = np.zeros(len(tokens), np.int64)
        number[single] = which
        out = np.where(out < 0, held[np.repeat(number, size), inside], out)
        return np.bincount(owner, size, n).astype(np.int64), out.astype(np.int32)


class Words:
    """Ids of words, kept by one worker process in flat arrays."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.pattern = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+") if encoder.splits else re.compile(".+", re.DOTALL)
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.start, self.chars = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def encode(self, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts, each with the end id behind."""
        if len(self.number) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self._clear()
        number, words, counts = self.number, [], []
        for t in texts:
            own = self.pattern.findall(BLANK + t.replace(" ", BLANK)) if t else []
            words += own
            counts.append(len(own))
        self._learn(set(words).difference(number))
        which = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        start = self.start
        sizes = (start[1:] - start[:-1])[which] if len(which) else which
        # Every text takes one more place, for the end id.
        owner = np.repeat(np.arange(len(texts)), counts)
        places = np.bincount(owner, sizes, len(texts)).astype(np.int64) + 1
        offsets = np.append(0, np.cumsum(places))
        out = np.full(int(offsets[-1]), end, np.int32)
        inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        target = np.ones(len(out), bool)
        target[offsets[1:] - 1] = False
        out[target] = self.ids[inside + np.repeat(start[which], sizes)]
        return offsets, out


    def _learn(self, words: set[str]) -> None:
        short, long = [], []
        for w in words:
            (short if len(w) <= SHORT and self.encoder.can_step(w) else long).append(w)
        counts, ids = self.encoder.encode_many(short)
        own = [np.array(self.encoder.encode(w), np.int32) for w in long]
        sizes = np.concatenate([counts, np.array([len(o) for o in own], np.int64)])
        for w in chain(short, long):
            self.number[w] = len(self.number)
        self.chars += sum(map(len, words))
        self.ids = np.concatenate([self.ids, ids, *own])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])


@lru_cache(maxsize=2)
def worker_words(vocabulary: Vocabulary) -> Words:
    return Words(Encoder(vocabulary))


class Decoder:
    """Text of rows of ids, as the library gives it."""

    def __init__(self, vocabulary: Vocabulary):
        kinds, texts = vocabulary.kinds, vocabulary.texts
        self.bytes = {i: int(t[1:-1], 16) for i, (t, k) in enumerate(zip(texts, kinds, strict=True)) if k == BYTE}
        surface = {NORMAL: None, BYTE: "", CONTROL: "", UNKNOWN: vocabulary.unknown_surface}
        self.surface = [t.replace(BLANK, " ") if k == NORMAL else surface[k] for t, k in zip(texts, kinds, strict=True)]
        self.starts_blank = {i for i, (t, k) in enumerate(zip(texts, kinds, strict=True)) if k == NORMAL and t[0] == BLANK}
        self.silent = {i for i, k in enumerate(kinds) if k == CONTROL}

    def decode(self, ids: list[int]) -> str:
        surface, held, out = self.surface, self.bytes, []
        run = bytearray()
        # The blank that encoding puts in front goes, if the first id that is not a control one has it.
        first = next((i for i in ids if i not in self.silent), None)
        for i in ids:
            if i in held:
                run.append(held[i])
                continue
            if run:
                out.append(_characters(run))
                run.clear()
            out.append(surface[i])
        if run:
            out.append(_characters(run))
        text = "".join(out)
        return text[1:] if first in self.starts_blank else text


def _characters(run: bytearray) -> str:
    """UTF-8 of a run of byte ids; every byte that is no part of a character becomes U+FFFD by itself."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            width = 1 if run[at] < 0x80 else 2 if run[at] < 0xE0 else 3 if run[at] < 0xF0 else 4
            try:
                out.append(run[at : at + width].decode())
                at += width
            except UnicodeDecodeError:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def worker_decoder(vocabulary: Vocabulary) -> Decoder:
    return Decoder(vocabulary)


def encode_pieces(df: DataFrame, model_path: str, id: str = "doc_id", text: str = "text", ids: str = "ids") -> DataFrame:
    """One row per row of `df`: `id` and `ids` (array of int), the library's ids of the whole text and one end id.

    Null and empty texts have the end id alone; a null id stays; repeated rows each give a row; an empty table gives none;
    other columns are not read. A text is encoded whatever its length; a word without a blank takes four bytes per
    character while it is encoded. `model_path` is read on the driver and its vocabulary broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(model_path))
    kind = to_arrow_type(df.schema[id].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_words(shared.value)
        for part in text_pieces(cuts(batches, text, CUT_BYTES), text):
            offsets, flat = words.encode(part[text], shared.value.end)
            low = 0
            while low < len(part[text]):
                high = max(int(np.searchsorted(offsets, offsets[low] + BATCH_IDS, "right")) - 1, low + 1)
                values = pa.array(flat[offsets[low] : offsets[high]])
                lists = pa.ListArray.from_arrays(pa.array((offsets[low : high + 1] - offsets[low]).astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([pa.array(part[id][low:high], kind), lists], names=[id, ids])
                low = high

    return df.select(id, text).mapInArrow(run, f"`{id}` {dict(df.dtypes)[id]}, `{ids}` array<int>")


def decode_pieces(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows of `df` with one more column `text`: what the library's decode gives for `ids`.

    Null ids give null, no ids the empty text; bytes that are no characters give U+FFFD; ids outside the vocabulary, or null
    within a row, raise. Repeated rows each give a row, an empty table none; a column named as `text` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(model_path))
    kept = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = worker_decoder(shared.value)
        for batch in batches:
            # A batch is cut where its texts, at up to 16 characters an id, would near the bound of one text column.
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [None if row is None else decoder.decode(row) for row in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, text])

    schema = ", ".join(f"`{c}` {k}" for c, k in df.select(*kept).dtypes)
    return df.select(*kept).mapInArrow(run, f"{schema}, `{text}` string")


def piece_report(df: DataFrame, model_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, n_tokens, ids_sha256 (of the decimal ids, joined by blanks), decoded_sha256 (of the text decoded from them)."""
    encoded = encode_pieces(df, model_path, id, text, "_ids")
    said = F.array_join(F.col("_ids").cast("array<string>"), " ")
    digests = encoded.select(id, "_ids", F.sha2(said, 256).alias("ids_sha256"))
    decoded = decode_pieces(digests, model_path, "_ids", "_decoded")
    return decoded.select(
        id,
        F.size("_ids").cast("bigint").alias("n_tokens"),
        "ids_sha256",
        F.sha2(F.col("_decoded"), 256).alias("decoded_sha256"),
    )
