"""Cut many texts into pre-tokens at once, on arrays of code points, and number the distinct ones.

Two cutting rules, both stated by the regular expressions of the tokenizer files: byte-level pre-tokens carry one leading
space; word pre-tokens drop white space and take digits one by one. Only texts whose code points all lie in a plain range
are cut here, where character classes are beyond doubt; the caller gives all others to the tokenizer library whole.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd

SPACE, LETTER, NUMBER, OTHER, BREAK = range(5)
#: Code points below this, and general punctuation, are plain; the dotted capital I changes its length in lower case.
LATIN = 0x180
PUNCTUATION = range(0x2010, 0x2028)
TOP = 0x2028
SEPARATOR = ""
DOTTED_I = 0x130
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.full(0x10000, OTHER, np.uint8)
    plain = np.zeros(0x10000, bool)
    for c in (*range(LATIN), *PUNCTUATION):
        category = unicodedata.category(chr(c))
        kind[c] = SPACE if c in WHITE_SPACE else {"L": LETTER, "N": NUMBER}.get(category[0], OTHER)
        plain[c] = c != DOTTED_I
    kind[ord(SEPARATOR)] = BREAK
    mix = np.random.default_rng(20240229).integers(1, 2**63, 0x10000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return kind, plain, mix


KIND, PLAIN, MIX = _tables()
_STEP = np.uint64(0x9E3779B97F4A7C15)


def is_plain(text: str) -> bool:
    if text.isascii():
        return True
    codes = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    return bool(PLAIN[codes].all())


@dataclass
class Pretokens:
    """`text` joins the plain texts; pre-token i is text[start[i]:end[i]], one of `distinct` (places of a first one), and
    belongs to text `owner[i]`. Pre-tokens are in reading order."""

    text: str
    start: np.ndarray
    end: np.ndarray
    number: np.ndarray
    distinct: np.ndarray
    owner: np.ndarray

    def strings(self) -> list[str]:
        text = self.text
        return [text[a:b] for a, b in zip(self.start[self.distinct].tolist(), self.end[self.distinct].tolist(), strict=True)]


def cut(texts: list[str], words: bool) -> Pretokens:
    """`words`: the word rule, on texts already in lower case; otherwise the byte-level rule. Texts must be plain."""
    joined = SEPARATOR + "".join(t + SEPARATOR for t in texts)
    codes = np.frombuffer(joined.encode("utf-16-le"), np.uint16)
    kind = KIND[codes]
    begin = np.empty(len(kind), bool)
    begin[0] = True
    begin[1:] = kind[1:] != kind[:-1]
    if words:
        begin |= kind == NUMBER
        scanned = np.ones(len(kind), bool)
    else:
        blank = codes == 0x20
        white = kind == SPACE
        # The last white-space character before a word starts a piece; if it is a blank, the word joins it.
        last = np.zeros(len(kind), bool)
        last[:-1] = white[:-1] & ~white[1:] & (kind[1:] != BREAK)
        begin |= last
        scanned = np.ones(len(kind), bool)
        scanned[1:] = ~blank[:-1]
        begin[1:] &= ~(last[:-1] & blank[:-1])
    _contractions(codes, kind, begin, scanned)
    start = np.flatnonzero(begin)
    end = np.append(start[1:], len(kind))
    wanted = kind[start] != BREAK
    if words:
        wanted &= kind[start] != SPACE
    fences = np.flatnonzero(kind == BREAK)
    start, end = start[wanted], end[wanted]
    owner = np.searchsorted(fences, start) - 1
    number, distinct = _numbered(codes, start, end)
    return Pretokens(joined, start, end, number, distinct, owner)


def _contractions(codes: np.ndarray, kind: np.ndarray, begin: np.ndarray, scanned: np.ndarray) -> None:
    """'s 't 're 've 'm 'll 'd are pieces of their own where a piece may start at the apostrophe."""
    at = np.flatnonzero(codes == 0x27)
    at = at[(kind[at - 1] != OTHER) & scanned[at]]
    if not len(at):
        return
    one = codes[at + 1]
    two = codes[np.minimum(at + 2, len(codes) - 1)]
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    for hit, length in ((at[single], 2), (at[double & ~single], 3)):
        begin[hit] = True
        begin[hit + 1] = False
        behind = hit + length
        # A letter that would have gone on with the run now starts a piece; anything else starts one already.
        begin[behind[kind[behind] == LETTER]] = True


def _numbered(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal pre-tokens get equal numbers; the first of each. Hashes decide, then every one is compared with its first."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = end - start
    edge = np.cumsum(length) - length
    inside = np.arange(int(length.sum())) - np.repeat(edge, length)
    place = inside + np.repeat(start, length)
    terms = (MIX[codes[place]] ^ (inside.astype(np.uint64) * _STEP)) * _STEP
    terms ^= terms >> np.uint64(29)
    hashed = np.add.reduceat(terms * _STEP, edge)
    number, _ = pd.factorize(hashed)
    distinct = np.full(number.max() + 1, -1, np.int64)
    distinct[number[::-1]] = np.arange(len(number))[::-1]
    first = distinct[number]
    same = (length == length[first]).all() and (
        codes[place] == codes[np.minimum(inside + np.repeat(start[first], length), len(codes) - 1)]
    ).all()
    if not same:
        text = codes.tobytes()
        keys = [text[2 * a : 2 * b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        number, _ = pd.factorize(np.array(keys, object))
        distinct = np.full(number.max() + 1, -1, np.int64)
        distinct[number[::-1]] = np.arange(len(number))[::-1]
    return number, distinct
