"""Tables kept up to date from change feeds, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import as_of_control
from tidemark.sinks.writers import KeyedTable


class EnrichedView:
    """Left join of two change feeds, kept per left key.

    A batch holds changes of both sides, told apart by `side` (left or right), each with `op_type`
    and `seq`. Only left rows that changed, or whose right row changed, are joined again.
    """

    def __init__(
        self, spark: SparkSession, path: str, left_key: str, right_key: str, link: str,
        left_columns: list[str], right_columns: list[str],
    ):
        self.left_key, self.right_key, self.link = left_key, right_key, link
        self.left_columns, self.right_columns = left_columns, right_columns
        self.left = KeyedTable(spark, f"{path}/left", [left_key], "seq")
        self.right = KeyedTable(spark, f"{path}/right", [right_key], "seq")
        self.view = KeyedTable(spark, f"{path}/view", [left_key])

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        lefts = changes.filter("side = 'left'").select(
            self.left_key, self.link, *self.left_columns, "op_type", "seq")
        rights = changes.filter("side = 'right'").select(
            self.right_key, *self.right_columns, "op_type", "seq")
        self.left.upsert(lefts, batch_id, "op_type")
        self.right.upsert(rights, batch_id, "op_type")

        now_left = self.left.current().select(self.left_key, self.link, *self.left_columns)
        now_right = self.right.current().select(self.right_key, *self.right_columns)
        moved = now_left.join(
            rights.select(F.col(self.right_key).alias(self.link)).distinct(), self.link, "left_semi")
        touched = lefts.select(self.left_key).unionByName(moved.select(self.left_key)).distinct()
        fresh = (
            touched.withColumn("_touched", F.lit(True))
            .join(now_left.withColumn("_here", F.lit(True)), self.left_key, "left")
            .join(now_right, F.col(self.link) == F.col(self.right_key), "left")
            .withColumn("op", F.when(F.col("_here"), "U").otherwise("D"))
            .select(self.left_key, *self.left_columns, *self.right_columns, "op"))
        self.view.upsert(fresh, batch_id, "op")

    def current(self) -> DataFrame:
        return self.view.current().drop("op")


class ControlledBranch:
    """Gives rows the control value in force at their time.

    Control rows (`is_control`) are filed per batch; rows are matched with all filed so far, so a
    control message must arrive no later than the rows it governs.
    """

    def __init__(self, spark: SparkSession, path: str, ts: str, value: str, default: str):
        self.spark, self.path, self.ts, self.value, self.default = spark, path, ts, value, default

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        control = batch.filter("is_control").select(self.ts, self.value)
        control.write.mode("overwrite").parquet(f"{self.path}/control/batch={batch_id}")
        known = self.spark.read.parquet(f"{self.path}/control").filter(F.col("batch") <= batch_id)
        rows = batch.filter("not is_control").drop("is_control", self.value)
        as_of_control(rows, known.drop("batch"), self.ts, self.value, self.default).write.mode(
            "overwrite").parquet(f"{self.path}/rows/batch={batch_id}")

    def current(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows").drop("batch")
