"""Bidirectional FM-index over a delimited vocabulary, and its search scheme for words one edit apart.

The words are sorted, so the delimiters in front of them rank as the words do: the rows of a suffix array that start with a
delimiter are the words in order (behind the one that ends the text), and the place of a pattern with its delimiters is the
number of its word. Two indexes, of the words and of the reversed words, hold one interval each for every pattern; a step to
either side moves the one by ranks and the other by the number of smaller symbols. Searches are run for many patterns at
once, on arrays of intervals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols between two counted places of a transformed text.
STRIDE = 16
_LANES = np.arange(STRIDE)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text read in a circle; 0 is the delimiter. Delimiters rank by their place, the last one first, as
    the first one follows it."""
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends), int(ends.sum()) + text).astype(np.int64)
    rank[-1] = 0
    n, width = len(text), 1
    while True:
        after = np.full(n, -1, np.int64)
        after[:-width or None] = rank[width:] if width < n else -1
        key = rank * (n + int(text.max()) + 2) + after + 1
        order = np.argsort(key, kind="stable")
        fresh = np.append(False, key[order][1:] != key[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class Side:
    """One of the two indexes: the transformed text with counts of smaller symbols at every STRIDE-th place."""

    def __init__(self, words: list[np.ndarray], symbols: int):
        text = np.zeros(sum(len(w) + 1 for w in words) + 1, np.int32)
        at = 1
        for w in words:
            text[at : at + len(w)] = w
            at += len(w) + 1
        order = suffix_order(text)
        before = text[order - 1]
        padded = np.full(-(-(len(before) + 1) // STRIDE) * STRIDE, symbols + 1, np.int32)
        padded[: len(before)] = before
        self.lanes = padded.reshape(-1, STRIDE).astype(np.uint8 if symbols < 255 else np.uint16 if symbols < 65535 else np.uint32)
        self.flat = self.lanes.reshape(-1)
        held = np.zeros((len(self.lanes) + 1, symbols + 3), np.int32)
        np.add.at(held, (np.repeat(np.arange(1, len(self.lanes) + 1), STRIDE), padded + 1), 1)
        np.cumsum(held, axis=0, out=held)
        self.below = np.cumsum(held, axis=1, dtype=np.int32)
        counts = np.bincount(text, minlength=symbols + 1)
        self.first = np.append(0, np.cumsum(counts))[: symbols + 1]
        self.size = len(text)

    def counts(self, symbol: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(smaller symbols, equal symbols) before the given places."""
        block, ahead = place // STRIDE, _LANES < (place % STRIDE)[:, None]
        row, s = self.lanes[block], symbol[:, None]
        less = self.below[block, symbol] + ((row < s) & ahead).sum(axis=1)
        upto = self.below[block, symbol + 1] + ((row <= s) & ahead).sum(axis=1)
        return less, upto - less


@dataclass
class Matches:
    """Intervals of patterns: where they start in the index that is stepped through and in the other one, their common
    size, the pattern, and how much of it is read."""

    own: np.ndarray
    other: np.ndarray
    size: np.ndarray
    query: np.ndarray
    read: np.ndarray

    def take(self, which: np.ndarray) -> Matches:
        return Matches(self.own[which], self.other[which], self.size[which], self.query[which], self.read[which])

    def turned(self) -> Matches:
        return Matches(self.other, self.own, self.size, self.query, self.read)


def joined(parts: list[Matches]) -> Matches:
    return Matches(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("own", "other", "size", "query", "read")))


def stepped(side: Side, m: Matches, symbol: np.ndarray, forth: int = 0) -> Matches:
    """The patterns with one more symbol on the side of an index; those that nothing has are left out."""
    less_low, low = side.counts(symbol, m.own)
    less_high, high = side.counts(symbol, m.own + m.size)
    out = Matches(side.first[symbol] + low, m.other + less_high - less_low, high - low, m.query, m.read + forth)
    return out.take(np.flatnonzero(out.size > 0))


class Vocabulary:
    """Both indexes over distinct words, which must be sorted by code points."""

    def __init__(self, words: list[str]):
        codes = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
        self.letters = np.unique(np.concatenate(codes)) if words else np.zeros(0, np.uint32)
        self.symbols = len(self.letters)
        numbers = [(np.searchsorted(self.letters, c) + 1).astype(np.int32) for c in codes]
        self.words = words
        self.left = Side(numbers, self.symbols)
        # Reversed words, sorted as they stand: by their symbols, shorter first.
        self.right = Side(sorted((n[::-1] for n in numbers), key=lambda n: n.astype(">i4").tobytes()), self.symbols)

    def numbered(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(matrix of symbols, one delimiter and more behind each word; lengths). Unknown letters are above all symbols."""
        length = np.array([len(w) for w in words])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.letters, codes)
        known = self.letters[np.minimum(at, max(self.symbols - 1, 0))] == codes if self.symbols else np.zeros(len(codes), bool)
        out = np.zeros((len(words), int(length.max()) + 1), np.int32)
        inside = np.arange(len(codes)) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(np.arange(len(words)), length), inside] = np.where(known, at + 1, self.symbols + 1)
        return out, length

    def within_one(self, queries: list[str], from_left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers, each pair once: the words that are one edit away from a query and share its left half
        (its first length // 2 letters), or its right half."""
        found = []
        # Words of like lengths together, so that padding at most doubles them.
        by_length: dict[int, list[int]] = {}
        for i, q in enumerate(queries):
            by_length.setdefault(len(q).bit_length(), []).append(i)
        for members in by_length.values():
            own = np.array(members)
            words = [queries[i] if from_left else queries[i][::-1] for i in members]
            query, word = self._search(words, from_left)
            found.append((own[query], word))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate([q * np.int64(len(self.words) + 1) + w for q, w in found]))
        return pairs // (len(self.words) + 1), pairs % (len(self.words) + 1)

    def _search(self, words: list[str], from_left: bool) -> tuple[np.ndarray, np.ndarray]:
        symbol, length = self.numbered(words)
        half = length // 2 if from_left else length - length // 2
        # Reading to the right steps through the reversed words, whose patterns grow at their own front.
        side, behind = (self.right, self.left) if from_left else (self.left, self.right)
        n = len(words)
        zero = np.zeros(n, np.int64)
        m = Matches(zero, zero, np.full(n, side.size), np.arange(n), zero)
        exact = []
        while len(m.query):
            done = m.read == half[m.query]
            exact.append(m.take(np.flatnonzero(done)))
            m = self._forth(side, m.take(np.flatnonzero(~done)), symbol)
        m = joined(exact)
        # The half has to be an end of the word: a delimiter behind it, on the other side.
        m = stepped(behind, m.turned(), np.zeros(len(m.query), np.int64)).turned()
        wrong = [m.take(np.zeros(0, np.int64))]
        while len(m.query):
            wrong += self._one_error(side, m, symbol, length)
            m = self._forth(side, m.take(np.flatnonzero(m.read < length[m.query])), symbol)
        m, full = joined(wrong), []
        while len(m.query):
            done = m.read == length[m.query]
            end = m.take(np.flatnonzero(done))
            full.append(stepped(side, end, np.zeros(len(end.query), np.int64)))
            m = self._forth(side, m.take(np.flatnonzero(~done)), symbol)
        m = joined(full) if full else m
        word = (m.other if from_left else m.own) - 1
        # The last delimiter is followed by the first one: the empty word, which is none.
        real = (word >= 0) & (word < len(self.words))
        return m.query[real], word[real]

    def _forth(self, side: Side, m: Matches, symbol: np.ndarray) -> Matches:
        """The patterns with the next symbol of their query."""
        following = symbol[m.query, m.read]
        known = np.flatnonzero(following <= self.symbols)
        return stepped(side, m.take(known), following[known], 1)

    def _one_error(self, side: Side, m: Matches, symbol: np.ndarray, length: np.ndarray) -> list[Matches]:
        """What one error at this place makes of the patterns: a letter of the query less, another one, one more."""
        inside = m.read < length[m.query]
        skipped = m.take(np.flatnonzero(inside))
        skipped = Matches(skipped.own, skipped.other, skipped.size, skipped.query, skipped.read + 1)
        which, letter = self._followers(side, m)
        more = stepped(side, m.take(which), letter)
        other = np.flatnonzero(inside[which] & (symbol[m.query[which], np.minimum(m.read[which], symbol.shape[1] - 1)] != letter))
        replaced = stepped(side, m.take(which[other]), letter[other], 1)
        return [skipped, more, replaced]

    def _followers(self, side: Side, m: Matches) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, letter) for the letters that follow the patterns: read off short intervals, tried one by one on long."""
        short = np.flatnonzero(m.size <= self.symbols)
        size = m.size[short]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        letter = side.flat[np.repeat(m.own[short], size) + inside].astype(np.int64)
        pairs = np.unique(np.repeat(short, size) * np.int64(self.symbols + 2) + letter)
        which, letter = pairs // (self.symbols + 2), pairs % (self.symbols + 2)
        real = (letter > 0) & (letter <= self.symbols)
        long = np.flatnonzero(m.size > self.symbols)
        every = np.arange(1, self.symbols + 1, dtype=np.int64)
        return (
            np.concatenate([which[real], np.repeat(long, self.symbols)]),
            np.concatenate([letter[real], np.tile(every, len(long))]),
        )
