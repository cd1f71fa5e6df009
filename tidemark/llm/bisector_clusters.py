"""Centroid clustering of whole-number vectors: rounds of assignment and floor means, exact throughout.

The nearest centroid is found by a tournament. For centroids a < b the bisector between them is a plane
with the whole normal 2 (b - a) and the whole threshold |b|^2 - |a|^2; a vector lies on the side of b if
normal . x > threshold. Normals and thresholds of all pairs are made once a task; each vector then takes
k - 1 sign tests, in which the winner so far meets the next centroid and zero favours the smaller number.
Only the winner's distance is computed.

Vectors stay where they are: a round sends the centroids to the tasks, and a task sends back at most one sum
for each centroid and component, whatever its rows, so a cluster with a third of all vectors is no more
work for anybody. Sums leave tasks in limbs of 48 bits and are put together as Python numbers, so they
never overflow; where products could leave 64 bits, tasks compute with Python numbers as well.

Kept are vectors with exactly `size` components, none null, infinite or NaN; other rows, a null vector
among them, are in no result. Repeated rows count and appear as often as they come. Two centroids with one
place leave the larger number empty, and an empty centroid stays. A null id is hashed as empty. With
fewer vectors than k each starts a cluster; without any the result is empty. Distances and inertias beyond
64 bits are given as the largest long. Extra columns change nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import written

CLUSTERS, ROUNDS, SIZE, SCALE = 40, 5, 64, 256
LIMB_BITS = 48
LARGEST = (1 << 63) - 1
# Rows that a task tests at once.
BLOCK_ROWS = 4096


def kept_vectors(embeddings: DataFrame, size: int = SIZE) -> DataFrame:
    """`vec_id`, `embedding` of the vectors with `size` finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return embeddings.select("vec_id", "embedding").filter((F.size("embedding") == size) & finite)


def whole(rows: np.ndarray) -> np.ndarray:
    """floor(256 x) of each component; Python numbers where 64 bits could not hold them."""
    if not len(rows) or np.abs(rows).max() < 1 << 40:
        return np.floor(SCALE * rows).astype(np.int64)
    return np.array([[_floor(x) for x in row] for row in rows.tolist()], object)


def _floor(x: float) -> int:
    a, b = x.as_integer_ratio()
    return SCALE * a // b


def first_centroids(vectors: DataFrame, k: int = CLUSTERS) -> list[list[int]]:
    """The k vectors whose ids have the smallest hashes, in that order."""
    name = F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(name, 256).alias("h"), "embedding").orderBy("h", "embedding").limit(k).collect()
    return [[_floor(float(x)) for x in r["embedding"]] for r in rows]


class Tournament:
    """Nearest of some centroids by sign tests against the bisectors of pairs."""

    def __init__(self, centroids: Sequence[Sequence[int]]):
        self.k = len(centroids)
        self.most = max((abs(x) for c in centroids for x in c), default=0)
        self.exact = np.array(centroids, object)
        self._made: dict[type, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def _bisectors(self, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centroids, normals and thresholds of all pairs."""
        if kind not in self._made:
            c = self.exact.astype(kind)
            squares = (c * c).sum(axis=1)
            self._made[kind] = c, 2 * (c[None] - c[:, None]), squares[None] - squares[:, None]
        return self._made[kind]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid of each row, and the squared distance."""
        most = int(np.abs(x).max()) if x.size else 0
        fits = 8 * max(1, x.shape[1]) * (most + self.most + 1) ** 2 < 1 << 62
        kind = np.int64 if fits and x.dtype != object else object
        x = x.astype(kind)
        c, normals, thresholds = self._bisectors(kind)
        winner = np.zeros(len(x), np.int64)
        for rival in range(1, self.k):
            normal, threshold = normals[:, rival], thresholds[:, rival]
            passed = (x * normal[winner]).sum(axis=1) > threshold[winner]
            winner[passed] = rival
        off = x - c[winner]
        return winner, (off * off).sum(axis=1)


def _blocks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[slice, np.ndarray]]:
    flat = batch["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(-1, size)
    for low in range(0, len(rows), BLOCK_ROWS):
        yield slice(low, low + BLOCK_ROWS), whole(rows[low:low + BLOCK_ROWS])


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """The 48-bit limbs of a whole number that are not zero, each with the number's sign."""
    sign, value, n = (-1 if value < 0 else 1), abs(value), 0
    while value:
        if low := value & ((1 << LIMB_BITS) - 1):
            yield n, sign * low
        value, n = value >> LIMB_BITS, n + 1


def next_centroids(vectors: DataFrame, centroids: Sequence[Sequence[int]]) -> list[list[int]]:
    """One round: every vector to its nearest centroid, then the floor mean of each centroid's vectors."""
    k, size = len(centroids), len(centroids[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tournament = Tournament(centroids)
        total, count = np.zeros((k, size), object), np.zeros(k, np.int64)
        for batch in batches:
            for _, x in _blocks(batch, size):
                winner, _ = tournament.nearest(x)
                for c in np.unique(winner):
                    own = x[winner == c]
                    total[c] += own.sum(axis=0)
                    count[c] += len(own)
        rows = [(c, -1, 0, int(count[c])) for c in range(k) if count[c]]
        rows += [(c, d, n, part) for c in range(k) for d in range(size) for n, part in limbs(int(total[c, d]))]
        names, kinds = ["cluster", "place", "limb", "part"], [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows), kinds, strict=True)], names=names)

    parts = vectors.mapInArrow(sums, "cluster int, place int, limb int, part long")
    added = parts.groupBy("cluster", "place", "limb").agg(F.sum(F.col("part").cast("decimal(28,0)")).alias("part"))
    totals = [[0] * size for _ in range(k)]
    counts = [0] * k
    for c, d, n, part in added.collect():
        if d < 0:
            counts[c] = int(part)
        else:
            totals[c][d] += int(part) << (LIMB_BITS * n)
    return [[t // counts[c] for t in totals[c]] if counts[c] else list(centroids[c]) for c in range(k)]


def nearest_centroids(vectors: DataFrame, centroids: Sequence[Sequence[int]]) -> DataFrame:
    """`vec_id`, `cluster`, `distance` of every vector."""
    size = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tournament = Tournament(centroids)
        for batch in batches:
            for rows, x in _blocks(batch, size):
                winner, distance = tournament.nearest(x)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch["vec_id"][rows], "cluster": pa.array(winner.astype(np.int32)),
                    "distance": pa.array([min(int(d), LARGEST) for d in distance], pa.int64())})

    return vectors.mapInArrow(run, f"vec_id {dict(vectors.dtypes)['vec_id']}, cluster int, distance long")


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> list[list[int]]:
    """The centroids after all rounds: k times the vectors' components, whatever the table."""
    centroids = first_centroids(vectors, k)
    for _ in range(rounds if centroids else 0):
        moved = next_centroids(vectors, centroids)
        if moved == centroids:
            break
        centroids = moved
    return centroids


def clusters(
    embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE
) -> DataFrame:
    """Every kept vector with its cluster, squared distance, the inertia of its cluster and of all, and the
    SHA-256 of its centroid's components."""
    vectors = kept_vectors(embeddings, size)
    spark, centroids = vectors.sparkSession, fit(vectors, k, rounds)
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        none = spark.createDataFrame([], schema)
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).join(
            none, "cluster").select("vec_id", "cluster", "distance", *none.columns[1:])
    assigned = written(nearest_centroids(vectors, centroids), "clusters")
    sums = dict(assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)"))).collect())
    inertia = min(int(sum(sums.values())), LARGEST)
    rows = [
        (c, min(int(sums[c]), LARGEST), inertia, hashlib.sha256(",".join(map(str, own)).encode()).hexdigest())
        for c, own in enumerate(centroids) if c in sums]
    # One row for each of the k centroids at most.
    return assigned.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _floor_mean(total: str, n: str) -> str:
    return f"(({total}) - ((({total}) % ({n})) + ({n})) % ({n})) // ({n})"


def _sql(k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE) -> str:
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), embedding) - 1 AS n, vec_id,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
parts AS MATERIALIZED (SELECT n, unnest(range({size})) AS d, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (SELECT n AS c, d, x FROM parts WHERE n < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT n, arg_min(c, far * {k} + c) AS c, min(far) AS far FROM (
    SELECT p.n, c.c, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS far
    FROM parts p JOIN c{i} c USING (d) GROUP BY p.n, c.c) GROUP BY n)""")
        if i < rounds:
            mean = _floor_mean("s", "m")
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT o.c, o.d, coalesce({mean}, o.x)::BIGINT AS x
  FROM c{i} o LEFT JOIN (
    SELECT a.c, p.d, sum(p.x)::BIGINT AS s, count(*) AS m FROM a{i} a JOIN parts p USING (n) GROUP BY a.c, p.d) t
    USING (c, d))""")
    return ",".join(steps) + f"""
SELECT k.vec_id, a.c::INT AS cluster, a.far AS distance,
  sum(a.far) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(a.far) OVER ()::BIGINT AS inertia,
  s.hash AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (n)
JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS hash FROM c{rounds} GROUP BY c) s USING (c)"""


CLUSTERS_SQL = _sql()
