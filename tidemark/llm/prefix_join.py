"""Near-duplicate documents by a grouped prefix join on word shingles.

Two documents link when the Jaccard likeness of their shingle sets reaches `percent`. All sets are
read in one order of shingles, rare ones first; a pair that links must then share a shingle of the
two prefixes, the first n - ceil(n * percent / 100) + 1 shingles. Documents with equal sets are one
set, sets with the same prefix and size one group.

The order comes from a count sketch over all documents, 4 bytes a slot. It only steers the work: any
order gives the same links, but with common shingles last a passage that thousands of documents share
stays out of their prefixes.

Groups that share a prefix shingle are candidates, under the size and position filters. They are first
compared with the shingle's middle, the group in whose prefix the shingle comes first: of edited copies
of one document that is the least edited one, as edits put rare shingles in front. That joins the copies
without going through their pairs. Only the sets that still lie outside their shingle's largest component
are paired with the rest. A histogram of each set bounds the shingles a pair can share; pairs that it cannot
exclude are verified on the whole sets. Every candidate pair is thus excluded by a bound, verified, or
within one component already.

Null or empty texts and texts of white space have an empty set and link with nothing. Rows with the
same id keep their rows. A null id takes part like any other, and is a component's id only where all
its ids are null. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.spread import components, count_sketch, with_first_owner, written
from tidemark.llm.text import Words, hash_of, map_batches, word_chunks

# Counters (of one byte) of the sketch that orders the shingles; more of them order rarer ones well.
ORDER_SLOTS = 1 << 23
# Slots (of one byte) of the histogram of a set.
HISTOGRAM = 256
# Marks (of one byte) that spare sets nobody needs the way through a shuffle.
MARK_SLOTS = 1 << 21


def _sets(words: Words, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The row number and sorted shingle set of each row that has one."""
    made, first = words.windows(size)
    for i, row in enumerate(words.rows):
        if first[i] < first[i + 1]:
            yield row, np.unique(made[first[i]:first[i + 1]])


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def _histogram(own: np.ndarray) -> bytes:
    slots = np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=HISTOGRAM)
    return np.minimum(slots, 255).astype(np.uint8).tobytes()


def _possible(percent: int):
    """Keeps the pairs `a`, `b` whose histograms `sa`, `sb` allow enough shared shingles."""

    def work(batch: pa.RecordBatch) -> dict:
        x, y = (
            np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, HISTOGRAM).astype(np.int32)
            for c in ("sa", "sb"))
        nx, ny = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("na", "nb"))
        # A full slot may hold more than it shows, and then bounds nothing.
        open_ended = ((x == 255) & (y == 255)).any(axis=1)
        most = np.where(open_ended, np.minimum(nx, ny), np.minimum(x, y).sum(axis=1))
        keep = (100 + percent) * most >= percent * (nx + ny)
        return {c: batch[c].filter(pa.array(keep)) for c in ("a", "b")}

    return work


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 80,
    shingle_words: int = 5, order_slots: int = ORDER_SLOTS,
) -> DataFrame:
    """One row for each document: `doc_id`, `n_shingles` (size of its set) and `component_id` (the
    smallest id that links reach, its own included)."""
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    spark = docs.sparkSession
    texts = docs.select("text")

    def hashed(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for words in word_chunks(batch["text"], lower=True):
            yield words.windows(shingle_words)[0]

    order = spark.sparkContext.broadcast(count_sketch(texts, hashed, order_slots))

    def prefix_of(own: np.ndarray) -> np.ndarray:
        """The rarest shingles of a sorted set, rare ones first, ties by their hash."""
        length = len(own) + (-percent * len(own)) // 100 + 1
        often = order.value[(own & np.uint64(order_slots - 1)).astype(np.int64)]
        return own[np.argsort(often, kind="stable")[:length]]

    def describe(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        sizes, keys, groups = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        shapes: list[bytes | None] = [None] * n
        for words in word_chunks(batch["text"], lower=True):
            for row, own in _sets(words, shingle_words):
                sizes[row], keys[row] = len(own), hash_of(own)
                groups[row] = hash_of(np.append(prefix_of(own), np.uint64(len(own))))
                shapes[row] = _histogram(own)
        empty = sizes == 0
        return {"doc_id": batch["doc_id"], "n_shingles": sizes, "set": pa.array(keys, mask=empty),
                "grp": pa.array(groups, mask=empty), "shape": pa.array(shapes, pa.binary())}

    def prefixes(batch: pa.RecordBatch) -> dict:
        tokens, groups, sizes, places = [], [], [], []
        for words in word_chunks(batch["text"], lower=True):
            for _, own in _sets(words, shingle_words):
                prefix = prefix_of(own)
                n = len(prefix)
                tokens.append(_signed(prefix))
                groups.append(np.full(n, hash_of(np.append(prefix, np.uint64(len(own)))), np.int64))
                sizes.append(np.full(n, len(own), np.int32))
                places.append(np.arange(n, dtype=np.int32))
        none = [np.empty(0, np.int64)]
        return {"token": np.concatenate(tokens or none), "grp": np.concatenate(groups or none),
                "n": np.concatenate(sizes or none).astype(np.int32),
                "place": np.concatenate(places or none).astype(np.int32)}

    members = written(
        map_batches(docs, describe, "doc_id long, n_shingles long, set long, grp long, shape binary"),
        "prefix-members")
    rows = map_batches(texts, prefixes, "token long, grp long, n int, place int")
    # One row for each token and group, however many copies a group's documents have.
    shared = written(with_first_owner(rows, "token", "grp").distinct(), "prefix-shared")

    # The sets that any comparison can need: those of groups with a shared token, and those of
    # groups that hold several sets.
    sets = members.filter("set is not null").select("set", "grp", "n_shingles", "shape").dropDuplicates(["set"])
    several = sets.groupBy("grp").agg(F.min("set").alias("a"), F.max("set").alias("b")).filter("a <> b")
    wanted = written(
        sets.join(shared.select("grp").unionByName(several.select("grp")).distinct(), "grp"), "prefix-wanted")

    def possible(pairs: DataFrame) -> DataFrame:
        """The pairs of sets that their histograms do not exclude."""
        x = wanted.select(F.col("set").alias("a"), F.col("n_shingles").alias("na"), F.col("shape").alias("sa"))
        y = wanted.select(F.col("set").alias("b"), F.col("n_shingles").alias("nb"), F.col("shape").alias("sb"))
        return map_batches(pairs.join(x, "a").join(y, "b"), _possible(percent), "a long, b long")

    def wanted_slots(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield batch["set"].to_numpy(zero_copy_only=False).view(np.uint64)

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs of sets that link, by their whole sets."""
        pairs = written(pairs, "prefix-pairs")
        both = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set")))
        needed = both.distinct()
        # A sketch of the needed sets spares the others the way through the shuffle.
        marks = spark.sparkContext.broadcast(count_sketch(needed, wanted_slots, MARK_SLOTS) > 0)

        def contents(batch: pa.RecordBatch) -> dict:
            keys, values = [], []
            for words in word_chunks(batch["text"], lower=True):
                for _, own in _sets(words, shingle_words):
                    key = hash_of(own)
                    if marks.value[key & (MARK_SLOTS - 1)]:
                        keys.append(key)
                        values.append(_signed(own))
            return {"set": pa.array(keys, pa.int64()), "items": pa.array(values, pa.list_(pa.int64()))}

        items = (
            map_batches(texts, contents, "set long, items array<long>")
            .join(needed, "set").dropDuplicates(["set"]))
        items = written(items, "prefix-sets")
        x = items.select(F.col("set").alias("a"), F.col("items").alias("x"))
        y = items.select(F.col("set").alias("b"), F.col("items").alias("y"))
        common = F.size(F.array_intersect("x", "y"))
        return (
            pairs.join(x, "a").join(y, "b")
            .filter((100 + percent) * common >= percent * (F.size("x") + F.size("y"))).select("a", "b"))

    def allowed(na: str, pa: str, nb: str, pb: str):
        """The size filter, and the position filter: how much two sets can share from here on."""
        reach = 1 + F.least(F.col(na) - F.col(pa) - 1, F.col(nb) - F.col(pb) - 1)
        return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb))
                & ((100 + percent) * reach >= percent * (F.col(na) + F.col(nb))))

    by_group = wanted.select("grp", "set")

    # Each set of a token with the head of the token's middle.
    least = F.min_by(F.struct("grp", "n", "place"), F.struct("place", "grp"))
    middle = shared.groupBy("token").agg(least.alias("least")).select(
        "token", F.col("least.grp").alias("g2"), F.col("least.n").alias("n2"), F.col("least.place").alias("p2"))
    groups = (
        shared.select("token", "grp", "n", "place").join(middle, "token").filter("grp <> g2")
        .filter(allowed("n", "place", "n2", "p2")).select("grp", "g2").distinct())
    heads = by_group.groupBy("grp").agg(F.min("set").alias("head"))
    stars = (
        groups.join(by_group.withColumnRenamed("set", "a"), "grp")
        .join(heads.select(F.col("grp").alias("g2"), F.col("head").alias("b")), "g2").select("a", "b"))
    within = by_group.join(heads, "grp").filter("set <> head").select(
        F.col("head").alias("a"), F.col("set").alias("b"))
    links = written(verified(possible(stars.unionByName(within).distinct())), "prefix-links")
    roots = components(links, "prefix-roots").withColumnRenamed("node", "set")
    rooted = written(
        by_group.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")), "prefix-rooted")

    # What is left: for each token the sets outside its largest component, with all its other sets.
    held = shared.select("token", "grp", "n", "place").join(rooted, "grp")
    sizes = held.groupBy("token", "root").agg(F.count("*").alias("sets"))
    main = sizes.groupBy("token").agg(
        F.max_by("root", F.struct("sets", "root")).alias("main"), F.count("*").alias("roots"))
    held = written(held.join(main.filter("roots > 1").drop("roots"), "token"), "prefix-held")
    odd = held.filter("root <> main")
    x = odd.select("token", F.col("set").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"),
                   F.col("root").alias("ra"))
    y = held.select("token", F.col("set").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"),
                    F.col("root").alias("rb"))
    open_pairs = (
        x.join(y, "token").filter(F.col("ra") != F.col("rb")).filter(allowed("na", "pa", "nb", "pb"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    # Sets of one group share all their prefix, in whatever token they are looked up.
    several_open = (
        rooted.alias("x").join(rooted.alias("y"), "grp")
        .filter("x.set < y.set and x.root <> y.root")
        .select(F.col("x.set").alias("a"), F.col("y.set").alias("b")))
    found = verified(possible(open_pairs.unionByName(several_open).distinct()))
    links = written(links.unionByName(found), "prefix-links")
    roots = components(links, "prefix-roots")

    named = (
        members.select("doc_id", "n_shingles", "set")
        .join(roots.withColumnRenamed("node", "set"), "set", "left")
        .withColumn("root", F.coalesce("root", "set")))
    lowest = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("low"))
    return (
        named.join(lowest, "root", "left")
        .select("doc_id", "n_shingles",
                F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("low"))
                .alias("component_id")))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its component. Rows equal in id and text are one;
    rows without an id stay, as no component can name them."""
    found = near_duplicates(docs, id, text, **options)
    kept = found.filter("doc_id = component_id").select(F.col("doc_id").alias("__kept_id")).distinct()
    key = F.col(id).cast("long")
    in_order = Window.partitionBy("__kept_id").orderBy(F.col(text))
    before, n = F.lag(F.col(text)).over(in_order), F.row_number().over(in_order)
    named = (
        docs.filter(key.isNotNull()).withColumn("__kept_id", key).join(kept, "__kept_id", "left_semi")
        .withColumn("__kept", (n == 1) | ~before.eqNullSafe(F.col(text))).filter("__kept"))
    return named.select(*docs.columns).unionByName(docs.filter(key.isNull()))


NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 4) + 1)) AS i FROM w WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * shared.n >= 80 * (a.n + b.n - shared.n)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, y FROM reach JOIN links ON links.x = reach.other)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
