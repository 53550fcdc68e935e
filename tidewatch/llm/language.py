"""Language identification: scripts narrow the candidates, words are scored, Viterbi labels spans of mixed text."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.batches import map_texts, pieces, slices

#: Labelled documents per language that a model is fitted on; a hash of the row draws them.
TRAIN_DOCS = 4000
#: Character pairs and triples are counted in so many hashed cells.
CELLS = 1 << 16
#: Log-likelihood that changing the language between two words costs.
SWITCH = 12.0
#: A language is a candidate for a script when it has this share of its training words in it.
SCRIPT_SHARE = 0.002
NOT_A_CANDIDATE = np.float32(-200.0)
#: Characters scored at once.
CHUNK_CHARS = 500_000

#: First code points of script ranges, in order (Unicode blocks, neighbours of one script joined).
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x1380, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "han"), (0x3040, "kana"),
    (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"),
    (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"),
    (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([first for first, _ in SCRIPTS])
_SCRIPT = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


@cache
def letters() -> np.ndarray:
    """1 for letters, 2 for marks that belong to the word they stand in, by code point."""
    kinds = {"L": 1, "M": 2}
    return np.array([kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)], np.uint8)


def lowered(text: str) -> str:
    """Lower case without any change of length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


@dataclass
class Words:
    """Words of many texts: where each starts and ends in its text, its text, its script and its cells."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    script: np.ndarray
    edge: np.ndarray
    pairs: np.ndarray
    triples: np.ndarray


def words_of(texts: list[str | None]) -> Words:
    """Cells of a word: of each of its letters and of its end, with the one and with the two characters before; what lies
    outside the word counts as 0, the end as 1."""
    joined = "".join(lowered(t or "") + "\n" for t in texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = letters()[codes]
    inside = kind == 1
    inside[1:] |= (kind[1:] == 2) & (kind[:-1] > 0)
    flips = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    start, end = flips[::2], flips[1::2]
    sizes = np.array([len(t or "") + 1 for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    text = np.searchsorted(first, start, "right") - 1
    script = _SCRIPT[np.searchsorted(_FIRST, codes[start], "right") - 1]
    shown = np.where(inside, codes, 0).astype(np.uint64)
    back, back_2 = np.concatenate([[0], shown[:-1]]), np.concatenate([[0, 0], shown[:-2]])
    back_2[1:][~inside[:-1]] = 0
    length = end - start + 1
    edge = np.cumsum(length) - length
    at = np.arange(int(length.sum())) + np.repeat(start - edge, length)
    own = np.where(inside[at], shown[at], 1)
    before, two = back[at].astype(np.uint64), back_2[at].astype(np.uint64)
    pairs = _cell(own * np.uint64(0x9E3779B97F4A7C15) + before * np.uint64(0xC2B2AE3D27D4EB4F))
    triples = _cell(
        own * np.uint64(0x9E3779B97F4A7C15) + before * np.uint64(0xC2B2AE3D27D4EB4F) + (two + np.uint64(7)) * np.uint64(0x165667B19E3779F9)
    )
    return Words(start - first[text], end - first[text], text, script, edge, pairs, triples)


def _cell(mixed: np.ndarray) -> np.ndarray:
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(40)) % np.uint64(CELLS)).astype(np.int64)


@dataclass
class LanguageModel:
    """`weight[cell]` has a log-likelihood per language, `allowed[script]` 0 or a penalty per language."""

    languages: list[str]
    weight: np.ndarray
    allowed: np.ndarray

    def word_scores(self, words: Words) -> np.ndarray:
        if not len(words.start):
            return np.zeros((0, len(self.languages)), np.float32)
        cells = self.weight[words.pairs]
        cells += self.weight[words.triples]
        return np.add.reduceat(cells, words.edge, axis=0) + self.allowed[words.script]


def fit_language_model(
    df: DataFrame, text: str = "text", lang: str = "lang", draw: str = "doc_id", bound: int = TRAIN_DOCS
) -> LanguageModel:
    """From rows with a text and a language; at most about `bound` documents per language, drawn by a hash of `draw`.

    Counts are summed by Spark per language and cell, so what reaches the driver is the size of the model.
    """
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.pmod(F.xxhash64(draw), F.lit(1 << 20)).alias("draw")
    )
    held = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not held:
        return LanguageModel([], np.zeros((CELLS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), np.float32))
    limit = F.create_map(*[F.lit(x) for k, n in held.items() for x in (k, int(min(1.0, bound / n) * (1 << 20)))])
    drawn = rows.where(F.col("draw") < limit[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in pieces(batches, "text", CHUNK_CHARS):
            words = words_of(part["text"])
            length = np.diff(np.append(words.edge, len(words.pairs)))
            for name in dict.fromkeys(part["lang"]):
                mine = np.array([x == name for x in part["lang"]])[words.text]
                cells = np.repeat(mine, length)
                total = sums.setdefault(name, np.zeros(CELLS + len(SCRIPT_NAMES), np.int64))
                total[:CELLS] += np.bincount(words.pairs[cells], minlength=CELLS)
                total[:CELLS] += np.bincount(words.triples[cells], minlength=CELLS)
                total[CELLS:] += np.bincount(words.script[mine], minlength=len(SCRIPT_NAMES))
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(total[at], pa.int64())],
                ["lang", "cell", "n"],
            )

    counts = drawn.mapInArrow(count, "lang string, cell bigint, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    names = sorted(set(found["lang"].to_pylist()))
    column = np.array([names.index(x) for x in found["lang"].to_pylist()], np.int64)
    totals = np.zeros((CELLS + len(SCRIPT_NAMES), len(names)))
    totals[found["cell"].to_numpy(), column] = found["n"].to_numpy()
    cells, scripts = totals[:CELLS], totals[CELLS:]
    weight = np.log((cells + 0.5) / (cells.sum(axis=0) + 0.5 * CELLS))
    # Only differences between languages matter, and they stay small in numbers of few bits.
    weight -= weight.max(axis=1, keepdims=True)
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    fits = share >= SCRIPT_SHARE
    fits |= ~fits.any(axis=1, keepdims=True)
    return LanguageModel(names, weight.astype(np.float32), np.where(fits, np.float32(0), NOT_A_CANDIDATE))


def viterbi(scores: np.ndarray, text: np.ndarray, switch: float) -> np.ndarray:
    """Best language of every word when each change within a text costs `switch`. All texts take each step together, the
    longest first, so that those still going on are always the leading rows."""
    label = np.zeros(len(scores), np.int16)
    if not len(scores):
        return label
    begin = np.flatnonzero(np.diff(text, prepend=-1))
    size = np.diff(np.append(begin, len(text)))
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    going = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
    before = np.zeros(scores.shape, np.int16)
    best = scores[begin].astype(np.float64)
    own = np.arange(scores.shape[1], dtype=np.int16)
    for t in range(1, int(size[0])):
        n = going[t]
        rows, state = begin[:n] + t, best[:n]
        top = state.argmax(axis=1)
        jump = state[np.arange(n), top][:, None] - switch
        stay = state >= jump
        before[rows] = np.where(stay, own, top[:, None])
        best[:n] = np.where(stay, state, jump) + scores[rows]
    label[begin + size - 1] = best.argmax(axis=1)
    for t in range(int(size[0]) - 1, 0, -1):
        rows = begin[: going[t]] + t
        label[rows - 1] = before[rows, label[rows]]
    return label


def label_texts(model: LanguageModel, texts: list[str | None], switch: float = SWITCH) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text; see `identify`."""
    parts, scored, low, held = [], [], 0, 0
    for i, t in enumerate([*texts, None]):
        if i == len(texts) or held > CHUNK_CHARS:
            words = words_of(texts[low:i])
            scored.append(model.word_scores(words))
            parts.append((words.start, words.end, words.text + low))
            low, held = i, 0
        held += len(t or "")
    start, end, text = (np.concatenate(x) for x in zip(*parts, strict=True))
    scores = np.concatenate(scored)
    if not model.languages or not len(start):
        return [("und", 0.0, []) for _ in texts]
    label = viterbi(scores, text, switch)
    share = np.zeros((len(texts), len(model.languages)))
    np.add.at(share, (text, label), end - start)
    main = share.argmax(axis=1)
    mine = label == main[text]
    total = np.zeros((len(texts), len(model.languages)))
    np.add.at(total, text[mine], scores[mine])
    chance = 1 / np.exp(total - total[np.arange(len(texts)), main][:, None]).clip(max=1e12).sum(axis=1)
    letters_of = share.sum(axis=1)
    score = share[np.arange(len(texts)), main] / np.maximum(letters_of, 1) * chance
    fresh = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
    last = np.append(fresh[1:], len(label)) - 1
    spans: list[list[dict]] = [[] for _ in texts]
    for i, k, a, b in zip(text[fresh].tolist(), label[fresh].tolist(), start[fresh].tolist(), end[last].tolist(), strict=True):
        spans[i].append({"lang": model.languages[k], "start": a, "end": b})
    return [
        (model.languages[m], float(s), x) if n else ("und", 0.0, [])
        for m, s, n, x in zip(main.tolist(), score.tolist(), letters_of.tolist(), spans, strict=True)
    ]


def identify(
    df: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None, switch: float = SWITCH
) -> DataFrame:
    """The columns `keep` of every row of `df` with lang_pred, score and lang_spans (array of lang, start, end).

    The language is that of most letters; the score is its share of them times its chance against the other languages over
    the words it has. A null text, one without a letter, or a model without languages gives `und`, 0 and no spans. Null
    ids stay, repeated rows each give a row, an empty table gives none. lang_pred, score and lang_spans replace columns of
    that name. No shuffle; the model is broadcast and its size depends on the number of languages only.
    """
    keep = [c for c in (keep or []) if c not in (text, "lang_pred", "score", "lang_spans")]
    types = dict(df.dtypes)
    added = "lang_pred string, score double, lang_spans array<struct<lang:string,start:bigint,end:bigint>>"
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keep], added])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in parts:
            found = label_texts(shared.value, part.pop(text), switch)
            names, scores, spans = (list(x) for x in zip(*found, strict=True))
            yield part | {"lang_pred": names, "score": scores, "lang_spans": spans}

    return map_texts(df.select(*keep, text), run, schema, text)


def keep_identified(df: DataFrame, model: LanguageModel, least: float, text: str = "text", switch: float = SWITCH) -> DataFrame:
    """The rows of `df`, all columns, whose text has a language with a score of at least `least`. With a model that has learned
    no language, those whose text has a letter. Null and empty texts go; null ids, repeated rows and an empty table stay as
    they are."""
    if not model.languages:
        return df.where(F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False)))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = label_texts(shared.value, batch.column(text).to_pylist(), switch)
            yield batch.filter(pa.array([name != "und" and score >= least for name, score, _ in found], pa.bool_()))

    return df.mapInArrow(run, df.schema)
