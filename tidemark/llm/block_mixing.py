"""Mixing sources to target weights, by blocks drawn through pseudorandom permutations.

The words of a source, document after document, are cut into blocks of `block_words`; the rest at the
end is a short block. A source's target is cut into slots of one block each. For every output shard the
number of a source's slots is drawn from a multinomial distribution over the shards, whose sum is the
source's number of slots, so targets are met. Slot n of a source is in epoch n // blocks; within an
epoch a keyed Feistel permutation of the full blocks says which block it takes, and the short block
comes last. The last slot of all takes only the words that are missing to the target. Slots and
documents then meet by (source, block).

Sources in code point order, null last, weigh `weights` in turn and share `percent` of all words. No
target is above `most` times its source's words; what is above is shared out again among the others.

A document's words are counted over its whole text; null and empty texts have none and are never taken.
Repeated rows are documents of their own, in the order of their ids and texts. Equal input, in whatever
partitions, gives equal results for the same seed. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.spread import written
from tidemark.llm.text import buffers, map_batches, mix, numbers, word_chunks

BLOCK_WORDS = 256
SHARD_WORDS = 1 << 22
# Documents of a source that are put in order together.
CHUNK_DOCUMENTS = 50_000
ROUNDS = 4


def targets(
    sizes: dict[str | None, int], weights: tuple[int, ...], percent: int, most: int
) -> dict[str | None, float]:
    """The target of each source."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_sources, out = percent * sum(sizes.values()) / 100, list(order), {}
    while open_sources:
        unit = left / sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if weight[s] * unit > most * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in open_sources}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= most * sizes[s]
        open_sources = [s for s in open_sources if s not in out]
    return out


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n - 1: a Feistel network over the next even number of bits,
    walked along its cycles until the value is below n."""
    if n < 2:
        return index.copy()
    half = np.uint64((max(2, (n - 1).bit_length()) + 1) // 2)
    mask = np.uint64((1 << int(half)) - 1)
    keys = numbers(key, ROUNDS)
    out = index.astype(np.uint64)
    walking = np.ones(len(out), bool)
    while walking.any():
        x = out[walking]
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[walking] = left << half | right
        walking = out >= n
    return out.astype(np.int64)


def _name(source: str | None) -> str:
    """A source's name in the tables: never null, and not that of another source."""
    return "" if source is None else "=" + source


def _key_of(name: str, *parts: int) -> int:
    return xxhash.xxh3_64_intdigest(name.encode() + b"".join(b"|%d" % p for p in parts)) >> 1


def _sized(batch: pa.RecordBatch) -> dict:
    sizes, keys = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.uint64)
    for words in word_chunks(batch["text"]):
        sizes[words.rows.start:words.rows.stop] = words.counts
    data, at = buffers(batch["text"])
    for i in range(batch.num_rows):
        keys[i] = xxhash.xxh3_64_intdigest(data[at[i]:at[i + 1]])
    return {"doc_id": batch["doc_id"], "source": batch["source"], "size": sizes,
            "text_key": keys.view(np.int64)}


class Mix:
    """The plan of a mix and its tables.

    `documents`: doc_id, source, size, text_key, start (place of its first word in the source's words).
    `slots`: source, shard, slot, epoch, block, words (how many it takes).
    `pieces`: the runs of a document's words that a slot takes.
    """

    def __init__(
        self, docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, most: int = 2,
        seed: int = 1, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        id: str = "doc_id", text: str = "text", source: str = "source",
    ):
        self.block_words = block_words
        docs = docs.select(
            F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
            F.col(source).cast("string").alias("source"))
        spark = docs.sparkSession
        sized = written(map_batches(
            docs, _sized, "doc_id long, source string, size long, text_key long"), "mix-sizes")
        # One row for each source comes to the driver, never one for each document.
        sums = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        self.sizes = {r["source"]: r["size"] for r in sums}
        self.targets = targets(self.sizes, weights, percent, most)
        chunks = max([1, *(math.ceil(r["n"] / CHUNK_DOCUMENTS) for r in sums)])

        self.plan = spark.createDataFrame(
            [(_name(s), self.sizes[s], self.targets[s]) for s in self.sizes],
            "name string, source_size long, target double")
        sized = sized.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(chunks))).withColumn(
            "name", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
        ordered = Window.partitionBy("name", "chunk").orderBy("doc_id", "text_key")
        by_chunk = Window.partitionBy("name").orderBy("chunk")
        at = sized.groupBy("name", "chunk").agg(F.sum("size").alias("sum")).select(
            "name", "chunk", F.coalesce(F.sum("sum").over(
                by_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("at"))
        inside = sized.withColumn("inside", F.coalesce(F.sum("size").over(
            ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        self.documents = written(
            inside.join(at, ["name", "chunk"]).select(
                "doc_id", "name", "size", "text_key", (F.col("inside") + F.col("at")).alias("start")),
            "mix-documents")
        self.slots = self._slots(spark, seed, shard_words)
        self.pieces = self._pieces()

    def _slots(self, spark, seed: int, shard_words: int) -> DataFrame:
        length = self.block_words
        sizes = {_name(s): n for s, n in self.sizes.items()}
        wanted = {_name(s): round(t) for s, t in self.targets.items()}
        shards = max(1, math.ceil(sum(wanted.values()) / shard_words))
        rows = [(s, sizes[s], wanted[s]) for s in wanted if wanted[s] > 0]

        def draw(batch: pa.RecordBatch) -> dict:
            """For every source its number of slots in each shard, and the first of them."""
            names, where, first, counts = [], [], [], []
            for source, size, want in zip(*(batch[c].to_pylist() for c in ("name", "size", "want")), strict=True):
                per_epoch = -(-size // length)
                n = want // size * per_epoch + -(-(want % size) // length)
                drawn = np.random.default_rng(_key_of(source, seed)).multinomial(n, np.full(shards, 1 / shards))
                names += [source] * shards
                where.append(np.arange(shards))
                counts.append(drawn)
                first.append(np.cumsum(drawn) - drawn)
            none = [np.empty(0, np.int64)]
            return {"name": pa.array(names, pa.string()), "shard": np.concatenate(where or none),
                    "first": np.concatenate(first or none), "n": np.concatenate(counts or none)}

        def place(batch: pa.RecordBatch) -> dict:
            """Epoch, block and words of every slot."""
            slot = batch["slot"].to_numpy(zero_copy_only=False).astype(np.int64)
            coded = batch["name"].dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            epoch, block, words = (np.zeros(len(slot), np.int64) for _ in range(3))
            for code, source in enumerate(coded.dictionary.to_pylist()):
                own = np.flatnonzero(codes == code)
                size, want = sizes[source], wanted[source]
                full, per_epoch = size // length, -(-size // length)
                e, i = slot[own] // per_epoch, slot[own] % per_epoch
                b = i.copy()
                for k in np.unique(e):
                    part = np.flatnonzero((e == k) & (i < full))
                    b[part] = permuted(i[part], full, _key_of(source, seed, int(k)))
                epoch[own], block[own] = e, b
                taken_before = e * size + np.minimum(i, full) * length
                words[own] = np.minimum(np.minimum(length, size - b * length), want - taken_before)
            return {"name": batch["name"], "shard": batch["shard"], "slot": slot, "epoch": epoch,
                    "block": block, "words": words}

        drawn = map_batches(
            spark.createDataFrame(rows, "name string, size long, want long").repartition(
                max(1, min(len(rows), 64))), draw, "name string, shard long, first long, n long")
        # A hot source's slots are spread over the shards before they are written out one by one.
        listed = drawn.filter("n > 0").repartition("name", "shard").select(
            "name", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("slot"))
        return map_batches(
            listed, place, "name string, shard long, slot long, epoch long, block long, words long")

    def _pieces(self) -> DataFrame:
        """The first word and number of words that every slot takes of a document; a document with
        words is known by its source's name and its start."""
        length = self.block_words
        held = self.documents.filter("size > 0").select(
            "doc_id", "name", "size", "start", "text_key", F.explode(F.sequence(
                F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("size") - 1) / length))).alias("block"))
        low = F.greatest(F.col("start"), F.col("block") * length)
        high = F.least(F.col("start") + F.col("size"), F.col("block") * length + F.col("words"))
        # Spark sees few rows before the slots are written out one by one, and would send them around.
        return (
            held.join(self.slots.hint("merge"), ["name", "block"]).filter(high > low)
            .select("doc_id", "name", "start", "text_key", "shard", "slot", "epoch",
                    (low - F.col("start")).alias("from_word"), (high - low).alias("n_words")))

    def digest(self) -> DataFrame:
        """doc_id, size, source_size, target, taken of every document."""
        taken = self.pieces.groupBy("name", "start").agg(F.sum("n_words").alias("taken"))
        with_words = self.documents.filter("size > 0").join(taken, ["name", "start"], "left")
        without = self.documents.filter("size = 0").withColumn("taken", F.lit(0))
        # The plan has one row for each source, as many as the driver holds of it already.
        return (
            with_words.unionByName(without).join(F.broadcast(self.plan), "name")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


def mixed_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The rows of `docs` as the mix takes them, one for each epoch that takes some of a document's
    words: the text is cut to the words taken (runs of words keep the white space between them and are
    joined by a line break) and `n_chars`, where there is such a column, counted anew. Rows equal in
    id, text and source take their other columns from one of them."""
    plan = Mix(docs, id=id, text=text, source=source, **options)
    runs = plan.pieces.groupBy("doc_id", "text_key", "name", "start", "epoch").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "n_words"))).alias("runs")).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__mix_id"),
        F.col("text_key").alias("__mix_key"), F.col("name").alias("__mix_name"), F.col("runs").alias("__mix_runs"))
    keys = ["__mix_id", "__mix_key", "__mix_name"]

    def with_key(batches):
        for batch in batches:
            data, at = buffers(batch[text].cast(pa.string()))
            values = [xxhash.xxh3_64_intdigest(data[at[i]:at[i + 1]]) for i in range(batch.num_rows)]
            yield batch.append_column("__mix_key", pa.array(np.array(values, np.uint64).view(np.int64)))

    keyed = docs.mapInArrow(with_key, _plus(docs, "__mix_key", "long")).withColumns({
        "__mix_id": F.coalesce(F.col(id).cast("long").cast("string"), F.lit("")),
        "__mix_name": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))})
    one = Window.partitionBy(*keys).orderBy(F.lit(1))
    taken = (
        keyed.withColumn("__mix_copy", F.row_number().over(one)).filter("__mix_copy = 1")
        .join(runs, keys).select(*docs.columns, "__mix_runs"))

    names = docs.columns

    def cut(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            made = _cut(batch[text].cast(pa.string()), batch["__mix_runs"].to_pylist())
            columns = {n: batch[n] for n in names} | {text: pa.array(made, pa.string())}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([len(t) for t in made]).cast(batch["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return taken.mapInArrow(cut, docs.schema)


def _plus(docs: DataFrame, name: str, kind: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{name} {kind}"])


def _cut(texts: pa.Array, runs: list[list[dict]]) -> list[str]:
    """Of each text the runs of words, neighbouring runs joined first."""
    out = []
    for words in word_chunks(texts):
        for i, row in enumerate(words.rows):
            joined: list[list[int]] = []
            for run in runs[row]:
                low, high = run["from_word"], run["from_word"] + run["n_words"]
                if joined and joined[-1][1] == low:
                    joined[-1][1] = high
                else:
                    joined.append([low, high])
            first = words.first[i]
            n = words.first[i + 1] - first
            if joined == [[0, n]]:
                parts = [words.data[words.row_at[i]:words.row_at[i + 1]]]
            else:
                parts = [words.data[words.starts[first + a]:words.ends[first + b - 1]] for a, b in joined]
            out.append("\n".join(p.tobytes().decode() for p in parts))
    return out
