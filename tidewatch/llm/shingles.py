"""Sets of word shingles as sorted 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np

WORDS = 5
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (x ^ np.uint64(salt & 0xFFFFFFFFFFFFFFFF)) * _STEP
    x ^= x >> np.uint64(30)
    x *= _TURN
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(n: int, seed: int) -> np.ndarray:
    """An odd number for every place."""
    return mixed(np.arange(n, dtype=np.uint64), seed + 6) | np.uint64(1)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted; for short arrays faster than np.unique."""
    values = np.sort(values)
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def shingle_sets(texts: list[str | None], seed: int = 0, words: int = WORDS) -> list[np.ndarray]:
    """Distinct shingles of each text, sorted; a text of fewer words has its whole sequence as the only one, and one
    without words none. A-Z are lowered; words are what stands between ASCII white space."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    codes = _LOWER[np.frombuffer(b" " + b" ".join(data) + b" ", np.uint8)]
    blank = _BLANK[codes]
    flips = np.flatnonzero(np.diff((~blank).astype(np.int8)))
    start, end = flips[::2] + 1, flips[1::2] + 1
    if not len(start):
        return [np.zeros(0, np.uint64) for _ in texts]
    length = end - start
    edge = np.cumsum(length) - length
    inside = np.arange(int(length.sum())) - np.repeat(edge, length)
    # A letter counts as its own number times that of its place in the word.
    letter = mixed(np.arange(256, dtype=np.uint64), seed + 1)[codes[inside + np.repeat(start, length)]]
    letter *= _places(int(length.max()), seed)[inside]
    word = mixed(np.add.reduceat(letter, edge) + length.astype(np.uint64), seed + 2)
    # The text that a word belongs to: texts are joined by one blank each.
    first = np.cumsum([1, *[len(d) + 1 for d in data]])
    bounds = np.searchsorted(start, first)
    whole = np.zeros(max(len(word) - words + 1, 0), np.uint64)
    for j, place in enumerate(_places(words, seed + 5)):
        whole += word[j : j + len(whole)] * place
    whole = mixed(whole, seed + 3)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(distinct(whole[a : b - words + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for w in word[a:b]:
                one = mixed(one + w, seed + 4)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_keys(shingles: np.ndarray) -> tuple[int, bytes]:
    """A 64-bit handle of a set, and 16 bytes that stand for it."""
    with np.errstate(over="ignore"):
        one = mixed(shingles, 11).sum(dtype=np.uint64) + np.uint64(len(shingles))
        two = mixed(shingles, 12).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), one.tobytes() + two.tobytes()
