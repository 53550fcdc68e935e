"""Quality scores by nearest neighbours: latent-semantic vectors of labelled documents vote, weighted by similarity."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.batches import map_texts, pieces

#: Labelled documents that are broadcast; a hash of the id draws them.
LABELLED = 5000
#: Hashed cells of character triples, latent dimensions, neighbours that vote, documents multiplied at once.
CELLS = 2048
DIMENSIONS = 64
NEIGHBOURS = 25
BLOCK = 512
#: Similarities are raised to this power, so near neighbours count most.
SHARPNESS = 8
#: Weight of the overall share of label 1 in every vote; it decides where no neighbour is near.
PRIOR = 1e-3
#: Steps of the measures of a whole text that join its triples as features, and the weight of each.
STEPS = 10
MEASURES = 6
MEASURE_WEIGHT = 0.35


def shapes(codes: np.ndarray) -> np.ndarray:
    """Characters with letters folded into classes (upper, lower, other letter) and digits into one; the rest as it is."""
    out = np.minimum(codes, 0x2FF).astype(np.uint32)
    out[(codes >= 0x61) & (codes <= 0x7A) | (codes >= 0xDF) & (codes <= 0xFF)] = 0x300
    out[(codes >= 0x41) & (codes <= 0x5A) | (codes >= 0xC0) & (codes <= 0xDE)] = 0x301
    out[codes >= 0x100] = 0x302
    out[(codes >= 0x30) & (codes <= 0x39)] = 0x303
    return out


def _cells(symbols: np.ndarray, salt: int) -> np.ndarray:
    mixed = symbols[2:].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed += symbols[1:-1].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(salt)
    mixed += symbols[:-2].astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(40)) % np.uint64(CELLS)).astype(np.int64)


def counts_of(texts: list[str | None]) -> np.ndarray:
    """Feature rows: log counts of triples of shapes and of characters, hashed, each row of unit length; behind them, the
    steps of measures (share of symbols, capitals, digits, long pieces; distinct words; distinct triples)."""
    out = np.zeros((len(texts), CELLS + MEASURES * STEPS), np.float32)
    for i, t in enumerate(texts):
        codes = np.frombuffer(("\n" + (t or "") + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(codes) < 3:
            continue
        shape = shapes(codes)
        own = _cells(codes, 1)
        row = np.bincount(_cells(shape, 0), minlength=CELLS) * 2.0 + np.bincount(own, minlength=CELLS)
        row = np.log1p(row)
        out[i, :CELLS] = row / np.sqrt((row * row).sum())
        n = max(len(codes) - 2, 1)
        words = (t or "").split()
        symbols = (shape < 0x300) & (codes > 0x20)
        measures = (
            symbols.sum() / n,
            (shape == 0x301).sum() / n,
            (shape == 0x303).sum() / n,
            min(1.0, max((len(w) for w in words), default=0) / 60),
            len(set(words)) / max(len(words), 1) ** 0.9,
            min(1.0, len(np.unique(own)) / min(n, CELLS)),
        )
        for k, m in enumerate(measures):
            step = min(int(max(0.0, min(m, 1.0)) ** 0.5 * STEPS), STEPS - 1)
            out[i, CELLS + k * STEPS + step] = MEASURE_WEIGHT
    return out


@dataclass
class QualityModel:
    """`weight` and `basis` take feature rows to latent vectors; `vectors` are those of labelled documents, of unit
    length, and `labels` their 0/1 labels."""

    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        latent = (counts * self.weight) @ self.basis
        return latent / np.maximum(np.sqrt((latent * latent).sum(axis=1, keepdims=True)), 1e-9)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Exact cosine products with every labelled vector, block by block; the nearest vote."""
        out, alone = np.empty(len(texts)), np.zeros(len(texts), bool)
        near = min(NEIGHBOURS, len(self.labels))
        for low in range(0, len(texts), BLOCK):
            cosine = self.project(counts_of(texts[low : low + BLOCK])) @ self.vectors.T
            top = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            vote = np.take_along_axis(cosine, top, axis=1).astype(np.float64).clip(min=0) ** SHARPNESS
            agreed = (vote * self.labels[top]).sum(axis=1) + PRIOR * self.labels.mean()
            out[low : low + BLOCK] = agreed / (vote.sum(axis=1) + PRIOR)
            alone[low : low + BLOCK] = vote.sum(axis=1) == 0
        # Products differ in their last digits with the rows they are made with; equal texts must not.
        return np.where(alone, self.labels.mean(), out.clip(0, 1).round(5))


def fit_quality_model(
    documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "label", bound: int = LABELLED
) -> QualityModel | None:
    """From the documents that `labels` gives a 0/1 label; at most about `bound` of them, drawn by a hash of the id.

    The draw is made on the labels, so only that bounded table of ids is broadcast to the documents. Feature rows of the
    drawn documents, of fixed width, reach the driver, which finds the latent dimensions. None without labelled documents.
    """
    rows = labels.where(F.col(label).isin(0, 1)).select(F.col(id).alias("_labelled"), F.col(label).cast("int").alias("label"))
    n = rows.count()
    if n > bound:
        rows = rows.where(F.pmod(F.xxhash64("_labelled"), F.lit(1 << 20)) < int(bound / n * (1 << 20)))
    texts = documents.select(F.col(id).alias("_id"), F.col(text).alias("text"))
    drawn = texts.join(F.broadcast(rows), F.col("_id") == F.col("_labelled")).select("text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", 500_000):
            rows = [row.astype(np.float16).tobytes() for row in counts_of(part["text"])]
            yield pa.RecordBatch.from_arrays([pa.array(part["label"], pa.int32()), pa.array(rows, pa.binary())], ["label", "row"])

    found = drawn.mapInArrow(count, "label int, row binary").orderBy("row", "label").toArrow()
    if not found.num_rows:
        return None
    counts = np.stack([np.frombuffer(r, np.float16) for r in found["row"].to_pylist()]).astype(np.float32)
    labels = found["label"].to_numpy().astype(np.float64)
    weight = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    weighted = counts * weight
    values, basis = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    basis = basis[:, np.argsort(values)[::-1][:DIMENSIONS]].astype(np.float32)
    model = QualityModel(weight, basis, np.zeros((0, DIMENSIONS), np.float32), labels)
    model.vectors = model.project(counts)
    return model


def score_quality(df: DataFrame, model: QualityModel | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of every row of `df` with score (0 to 1, the weighted share of neighbours labelled 1).

    Null and empty texts are near nobody and get the overall share of label 1. Without a model every score is 0.5. Null ids stay,
    repeated rows each give a row, an empty table gives none; a column named score is replaced. No shuffle; what is
    broadcast has the size of LABELLED vectors of DIMENSIONS numbers.
    """
    keep = [c for c in (keep or []) if c not in (text, "score")]
    types = dict(df.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keep], "score double"])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in parts:
            texts = part.pop(text)
            yield part | {"score": shared.value.scores(texts).tolist() if shared.value else [0.5] * len(texts)}

    return map_texts(df.select(*keep, text), run, schema, text)
