"""Spark helpers of this package: scratch tables, fixed-size count sketches, tokens that several
owners share, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Counters that travel in one row of a sketch.
PART_SLOTS = 1 << 16
# Hashes that a sketch adds at once.
ADDED = 1 << 19


def written(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read again: lineage ends there, and so the shuffle files that led
    to it go at once, not when the driver happens to collect its garbage."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(_CLEANED, "false")
    spark.conf.set(_CLEANED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANED, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete tables of `written` that nothing reads any more."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def count_sketch(
    df: DataFrame, slots_of: Callable[[pa.RecordBatch], Iterable[np.ndarray]], slots: int
) -> np.ndarray:
    """How many of all hashes fall in each of `slots` counters, up to 255: one byte a slot, whatever
    the input.

    Tasks count their rows in memory of that size; the counters are added part by part as a stream,
    so no task holds more than its parts. `slots` is a power of two of at least PART_SLOTS.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, n = np.zeros(slots, np.uint8), [], 0
        for batch in batches:
            for hashes in slots_of(batch):
                waiting.append((hashes & np.uint64(slots - 1)).astype(np.int32))
                n += len(hashes)
                if n > ADDED:
                    _add(total, waiting)
                    waiting, n = [], 0
        _add(total, waiting)
        yield from rows(enumerate(total.reshape(-1, PART_SLOTS)))

    def rows(parts: Iterable[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for part, counts in parts:
            if counts.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([counts.tobytes()], pa.binary())],
                    names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch["part"].to_pylist(), batch["counts"], strict=True):
                own = totals.setdefault(part, np.zeros(PART_SLOTS, np.int32))
                own += np.frombuffer(counts.as_buffer(), np.uint8)
        yield from rows((p, np.minimum(c, 255).astype(np.uint8)) for p, c in totals.items())

    # A few tasks for each core: every task sends a whole sketch, if it found that much.
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    schema = "part int, counts binary"
    filled = df.coalesce(tasks).mapInArrow(fill, schema)
    parts = slots // PART_SLOTS
    added = filled.repartition(min(parts, tasks), "part").mapInArrow(add, schema)
    total = np.zeros((parts, PART_SLOTS), np.uint8)
    for row in added.collect():
        total[row["part"]] = np.frombuffer(row["counts"], np.uint8)
    return total.reshape(-1)


def _add(total: np.ndarray, waiting: list[np.ndarray]) -> None:
    if waiting:
        slots, counts = np.unique(np.concatenate(waiting), return_counts=True)
        total[slots] = np.minimum(total[slots] + counts, 255)


def with_first_owner(rows: DataFrame, token: str, owner: str) -> DataFrame:
    """The rows whose token several owners have, with the smallest owner as `first_owner` and the
    largest as `last_owner`.

    Both are partial aggregates, so a token that a third of all rows holds reaches its reducer as
    one row for each map task; the join back is a plain one, whose skewed keys Spark splits.
    """
    shared = (
        rows.groupBy(token)
        .agg(F.min(owner).alias("first_owner"), F.max(owner).alias("last_owner"))
        .filter("first_owner <> last_owner"))
    return rows.join(shared, token)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """`node`, `root` for every node of the links `a`, `b` (whole numbers): the smallest node that
    it reaches. Each round takes the smallest root among neighbours, then the root's own root, so
    paths shrink by doubling; a round's result is written before the next."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.filter("a <> b").distinct(), label)
    roots = written(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        .select("node", F.least("node", "low").alias("root")), label)
    while True:
        near = (
            edges.join(roots.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        lower = (
            roots.join(near, "node")
            .select("node", F.col("root").alias("was"), F.least("root", "near").alias("low")))
        jump = roots.select(F.col("node").alias("low"), F.col("root").alias("beyond"))
        new = written(
            lower.join(jump, "low", "left")
            .select("node", "was", F.least("low", F.coalesce("beyond", "low")).alias("root")), label)
        dropped(roots)
        if new.filter("root <> was").isEmpty():
            dropped(edges)
            return new.select("node", "root")
        roots = new
