"""Late rows of a stream: kept windows are corrected, rows past that go to a late table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import PARTS
from tidemark.operators.lateness import windows_with_state
from tidemark.operators.slices import as_column
from tidemark.operators.windows import seconds


class LateSplit:
    """Batch function that files each row's windows, or the row itself when all are closed.

    A batch is judged by the newest event time of the batches before it. All it writes goes to
    folders named after the batch, so a repeated batch replaces its own output.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], ts: str, size: str, slide: str,
        delay: str, lateness: str, aggs: dict[str, tuple[str, str]],
    ):
        self.spark, self.path, self.keys, self.ts = spark, path, list(keys), ts
        self.size, self.slide, self.delay, self.lateness = size, slide, delay, lateness
        self.aggs = aggs

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            self._split(rows, batch_id)
        finally:
            rows.unpersist()

    def _split(self, rows: DataFrame, batch_id: int) -> None:
        newest = self._newest_before(batch_id)
        judged = rows.withColumn("_newest", F.lit(newest).cast("timestamp"))
        start = F.window(self.ts, self.slide).start
        wait = seconds(self.size) + seconds(self.delay) + seconds(self.lateness)
        closing = judged.withColumn("_closes", start + F.expr(f"interval {wait} seconds"))
        closing.filter(F.col("_closes") <= F.col("_newest")).drop("_closes", "_newest").write.mode(
            "overwrite").parquet(f"{self.path}/late/batch={batch_id}")
        placed = windows_with_state(
            judged, self.ts, self.size, self.slide, self.delay, self.lateness, "_newest")
        placed.filter("_open").groupBy(*self.keys, "_w").agg(
            *[PARTS[kind][0](as_column(c)).alias(n) for n, (kind, c) in self.aggs.items()]
        ).write.mode("overwrite").parquet(f"{self.path}/parts/batch={batch_id}")
        rows.agg(F.max(self.ts).alias("newest")).write.mode("overwrite").parquet(
            f"{self.path}/newest/batch={batch_id}")

    def _newest_before(self, batch_id: int):
        if batch_id == 0:
            return None
        marks = self.spark.read.schema("newest timestamp, batch long").parquet(f"{self.path}/newest")
        return marks.filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]

    def windows(self) -> DataFrame:
        """The window results so far; late but accepted rows have corrected them."""
        parts = self.spark.read.parquet(f"{self.path}/parts")
        merged = parts.groupBy(*self.keys, "_w").agg(
            *[PARTS[kind][1](n).alias(n) for n, (kind, _) in self.aggs.items()])
        return merged.select(
            *self.keys, F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"), *self.aggs)

    def late(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/late").drop("batch")
