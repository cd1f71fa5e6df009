"""Document quality by a vote of the nearest labelled documents in a latent-semantic space.

The terms of a document are the trigrams of its character classes, which see symbols, capitals, tables
and stray punctuation in any language, and bins of how often it repeats words, word windows and lines.
Term weights are log counts times inverse document frequency, at length one; the leading singular
vectors of the labelled sample give the latent space. The sample's vectors are sent to all tasks, which
compute the cosine of every document with every sample vector, block by block, and let the nearest
vote with weights that grow with the cosine.

The sample is at most `TRAIN_ROWS` labelled rows, those with the smallest hashed ids, so what is sent
is at most TRAIN_ROWS * DIMENSIONS * 4 bytes. Null and empty texts, and all texts where no label is
given, score the share of good labels (one half without labels). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import buffers, map_batches, word_chunks
from tidemark.llm.toxic_grammar import train_rows

TRAIN_ROWS = 4_000
DIMENSIONS = 48
NEIGHBOURS = 15
POWER = 8
BLOCK = 256

CLASSES = 16
# The class of every byte; all others are of class 0 (small letters) to 15 (control).
_CLASS = np.full(256, 15, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[192:], _CLASS[128:192] = 0, 1, 2, 13, 14
for _kind, _members in {3: b" \t", 4: b"\n", 5: b".", 6: b",", 7: b"!", 8: b"?", 9: b"|",
                        10: b"#*$%&<>", 11: b":;()[]{}-_/\\+=@^~`", 12: b"'\""}.items():
    _CLASS[list(_members)] = _kind
TRIGRAMS = CLASSES ** 3
BINS = 8
MEASURES = 4
TERMS = TRIGRAMS + BINS * MEASURES
# The count that a bin of a measure stands for.
BIN_COUNT = 50.0


def _bin(share: float) -> int:
    return min(BINS - 1, int(share * BINS))


def term_counts(column: pa.Array) -> Iterator[np.ndarray]:
    """The term counts of each text; all zero for a text without words."""
    data, at = buffers(column)
    for words in word_chunks(column, lower=True):
        made, first = words.windows(5)
        for i, row in enumerate(words.rows):
            out = np.zeros(TERMS, np.float32)
            own = words.of_row(i)
            if len(own):
                kinds = _CLASS[data[at[row]:at[row + 1]]].astype(np.int32)
                if len(kinds) > 2:
                    grams = (kinds[:-2] * CLASSES + kinds[1:-1]) * CLASSES + kinds[2:]
                    out[:TRIGRAMS] = np.bincount(grams, minlength=TRIGRAMS)
                windows = made[first[i]:first[i + 1]]
                lines = [x for x in data[at[row]:at[row + 1]].tobytes().split(b"\n") if x.strip()]
                shares = (
                    1 - len(np.unique(own)) / len(own), float((own[1:] == own[:-1]).mean()) if len(own) > 1 else 0.0,
                    1 - len(np.unique(windows)) / len(windows), 1 - len(set(lines)) / max(1, len(lines)))
                for m, share in enumerate(shares):
                    out[TRIGRAMS + BINS * m + _bin(share)] = BIN_COUNT
            yield out


@dataclass
class Space:
    """The latent space with the labelled vectors in it."""

    weights: np.ndarray  # inverse document frequency of each term
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled rows x dimensions, of length one
    labels: np.ndarray
    share: float

    def place(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors in the latent space for rows of term counts; zero stays zero."""
        return _unit(_weighted(counts, self.weights) @ self.axes)

    def vote(self, counts: np.ndarray) -> np.ndarray:
        """The weighted share of good labels among the nearest labelled rows."""
        if not len(self.labels):
            return np.full(len(counts), self.share)
        vectors = self.place(counts)
        cosines = vectors @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        close = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0) ** POWER
        total = close.sum(axis=1)
        score = (close * self.labels[nearest]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 0, score, self.share), 0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * weights)


def learn(rows: DataFrame, label: str = "quality") -> Space:
    """The space of a bounded sample of rows `text` and label."""

    def sparse(batch: pa.RecordBatch) -> dict:
        at, values = [], []
        for counts in term_counts(batch["text"]):
            used = np.flatnonzero(counts)
            at.append(used.astype(np.int16).tobytes())
            values.append(counts[used].tobytes())
        return {"label": batch[label], "at": pa.array(at, pa.binary()), "n": pa.array(values, pa.binary())}

    sample = map_batches(rows, sparse, "label int, at binary, n binary").collect()
    labels = np.array([r["label"] for r in sample], np.float32)
    share = float((labels.sum() + 0.5) / (len(labels) + 1))
    counts = np.zeros((len(sample), TERMS), np.float32)
    for row, r in zip(counts, sample, strict=True):
        row[np.frombuffer(r["at"], np.int16)] = np.frombuffer(r["n"], np.float32)
    filled = counts.any(axis=1)
    counts, labels = counts[filled], labels[filled]
    weights = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 0.1
    space = Space(weights, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), labels, share)
    if len(counts):
        x = _weighted(counts, weights)
        space.axes = _axes(x)
        space.vectors = _unit(x @ space.axes)
    return space


def _axes(x: np.ndarray, rounds: int = 4) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    k = min(DIMENSIONS, *x.shape)
    basis = np.random.default_rng(7).standard_normal((x.shape[1], k)).astype(np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    return np.ascontiguousarray(basis, np.float32)


def score_documents(docs: DataFrame, space: Space) -> DataFrame:
    """`doc_id` and `score` (0 to 1) of every row."""
    known = docs.sparkSession.sparkContext.broadcast(space)

    def work(batch: pa.RecordBatch) -> dict:
        scores, block = [], []
        for counts in term_counts(batch["text"]):
            block.append(counts)
            if len(block) == BLOCK:
                scores.append(known.value.vote(np.array(block)))
                block = []
        if block:
            scores.append(known.value.vote(np.array(block)))
        return {"doc_id": batch["doc_id"], "score": np.concatenate(scores).astype(np.float64)}

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        work, "doc_id long, score double")


__all__ = ["TRAIN_ROWS", "learn", "score_documents", "train_rows"]
