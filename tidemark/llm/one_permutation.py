"""Document fingerprints by one-permutation MinHash with optimal densification and packed low bits.

Each word shingle is hashed once. The upper bits choose one of `BINS` bins and the smallest hash of a
bin stands for it. An empty bin takes the value of the first filled bin on its own fixed random order
of the bins, the same for all documents. Of each bin the lowest `BITS` bits are kept and packed, so a
fingerprint takes BINS * BITS / 8 bytes (in hexadecimal here). Two bins agree by chance with
probability 2**-BITS, and the likeness of two fingerprints is corrected for that.

A text of fewer words than a shingle is one shingle. Null and empty texts and texts of white space have
the empty fingerprint: likeness 1 to each other, 0 to all others. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import buffers, map_batches, numbers, word_chunks

BINS = 512
BITS = 4
SHINGLE_WORDS = 5

_LOG = BINS.bit_length() - 1
# For each bin its random order of all bins, as the rank of every bin in it.
_RANKS = np.argsort(np.argsort(numbers(11, BINS * BINS).reshape(BINS, BINS), axis=1), axis=1).astype(np.int16)


def bins_of(hashes: np.ndarray) -> np.ndarray:
    """The lowest bits of the smallest hash of every bin, empty bins filled; nothing without hashes."""
    if not len(hashes):
        return np.empty(0, np.uint8)
    ordered = np.sort(hashes)
    at = (ordered >> np.uint64(64 - _LOG)).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    filled = at[head]
    low = (ordered[head] & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    out = np.zeros(BINS, np.uint8)
    out[filled] = low
    if len(filled) < BINS:
        empty = np.ones(BINS, bool)
        empty[filled] = False
        where = np.flatnonzero(empty)
        out[where] = low[_RANKS[where[:, None], filled].argmin(axis=1)]
    return out


def packed(bins: np.ndarray) -> str:
    return (bins[0::2] << BITS | bins[1::2]).tobytes().hex() if len(bins) else ""


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated Jaccard likeness of two documents from their bins, between 0 and 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    chance = 2.0 ** -BITS
    return min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance)))


def unpacked(fingerprint: str) -> np.ndarray:
    data = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    return np.stack([data >> BITS, data & ((1 << BITS) - 1)], axis=1).reshape(-1)


def _prints(column: pa.Array) -> list[np.ndarray]:
    out = []
    for words in word_chunks(column, lower=True):
        made, first = words.windows(SHINGLE_WORDS)
        out += [bins_of(made[first[i]:first[i + 1]]) for i in range(len(words.rows))]
    return out


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and `fingerprint` of every row."""

    def work(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch["doc_id"], "fingerprint": [packed(p) for p in _prints(batch["text"])]}

    return map_batches(
        docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
        work, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """The rows `doc_id`, `text` in partitions, each sorted by descending id (null ids last, ties by
    text) and followed by a row marked `guest`: a copy of the row that comes next in that order, which
    after the last row is the first.

    The ids are cut at quantiles, which are read first with each part's highest id: a few numbers for
    each part, whatever the rows. The texts then move once.
    """
    cuts = docs.select(
        F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10 * parts)
        if parts > 1 else F.array().cast("array<long>")).first()[0] or []
    cuts = sorted(set(cuts))
    edges = F.array(*[F.lit(c) for c in cuts]).cast("array<long>")
    # The number of cuts below the id; null ids follow the lowest ones.
    part = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(
        F.size(F.filter(edges, lambda c: c < F.col("doc_id"))))
    placed = docs.withColumn("part", part)
    heads = {r["part"]: r["head"] for r in placed.groupBy("part").agg(F.max("doc_id").alias("head")).collect()}
    parts_down = sorted(heads, reverse=True)
    # A part's head is the guest of the part above it, that of the highest part of the lowest.
    down = sorted(heads, reverse=True)
    above = {p: down[i - 1] for i, p in enumerate(down)}
    span = range(-1, len(cuts) + 1)

    def by_part(values: dict, kind: str):
        listed = F.array(*[F.lit(values.get(p)) for p in span]).cast(f"array<{kind}>")
        return F.get(listed, F.col("part") + 1)

    is_head = F.col("doc_id").eqNullSafe(by_part(heads, "long"))
    to = by_part(above, "int")
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("guest"))
    guest = F.struct(to.alias("part"), F.lit(True).alias("guest"))
    return (
        placed.select("doc_id", "text", F.explode(
            F.when(is_head, F.array(own, guest)).otherwise(F.array(own))).alias("at"))
        .select("doc_id", "text", "at.part", "at.guest")
        .repartition(max(1, parts), "part")
        .sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")))


def edited_prints(docs: DataFrame, id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """For every row its fingerprint, that of its edited text, and the likeness of its fingerprint to
    the edited text's and to the next row's.

    The edited text has the last floor(n / 2) of the n code points replaced by the first as many, or
    all, of the next row's text, by descending id; after the last row comes the first. Repeated ids
    follow each other by their texts; a table of one row follows itself.
    """
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row, which waits for the one after it
        guest_seen = False
        for batch in batches:
            prints = _prints(batch["text"])
            data, at = buffers(batch["text"])
            out: list[tuple] = []
            for i, (doc, part, guest) in enumerate(zip(
                    batch["doc_id"].to_pylist(), batch["part"].to_pylist(),
                    batch["guest"].to_pylist(), strict=True)):
                if guest and guest_seen:
                    continue  # more rows with the head's id
                row = doc, data[at[i]:at[i + 1]].tobytes().decode(), prints[i]
                if held is not None:
                    out.append((held, row))
                held, guest_seen = (None, True) if guest else (row, False)
            yield _pairs(out)

    columns = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
    return with_next(docs, parts).mapInArrow(work, columns)


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    edited, kept = [], []
    for (_, text, _), (_, after, _) in rows:
        half = len(text) // 2
        edited.append(text[:len(text) - half] + after[:half])
    prints = _prints(pa.array(edited, pa.large_string()))
    for ((doc, text, own), (_, _, following)), new, new_print in zip(rows, edited, prints, strict=True):
        kept.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), packed(own),
                     packed(new_print), likeness(own, new_print), likeness(own, following)))
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    columns = list(zip(*kept, strict=True)) if kept else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
