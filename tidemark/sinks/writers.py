"""Writers: console, delimited files, keyed tables, databases, fixed-size chunks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.scalar import key_text
from tidemark.operators.changelog import as_changelog


def print_rows(df: DataFrame, mode: str = "append") -> DataStreamWriter | None:
    """Print a result: at once for a batch, as a console writer for a stream."""
    if df.isStreaming:
        return df.writeStream.format("console").outputMode(mode).option("truncate", "false")
    df.show(truncate=False)
    return None


def append_delimited(df: DataFrame, path: str, checkpoint: str, sep: str = ",") -> DataStreamWriter:
    """Append a stream to delimited files, each row exactly once."""
    return df.writeStream.format("csv").options(
        path=path, sep=sep, checkpointLocation=checkpoint).outputMode("append")


class KeyedTable:
    """A table in the shared folder where the last write per key wins.

    Every batch writes its own folder, overwriting it when the batch is replayed, so a restarted
    stream leaves the same table. Reading keeps the newest row per key.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: str | None = None):
        self.spark, self.path, self.keys, self.order = spark, path, list(keys), order

    def upsert(self, rows: DataFrame, batch_id: int, op: str | None = None) -> None:
        """Write one batch. Within it, `order` decides which row of a key is the last; rows whose
        `op` is D delete their key."""
        if self.order:
            rest = F.struct(*[c for c in rows.columns if c not in self.keys])
            rows = rows.groupBy(*self.keys).agg(
                F.max_by(rest, self.order).alias("_row")).select(*self.keys, "_row.*")
        gone = F.col(op) == "D" if op else F.lit(False)
        rows.withColumn("_gone", gone).write.mode("overwrite").parquet(
            f"{self.path}/batch={batch_id}")

    def current(self, before_batch: int | None = None) -> DataFrame:
        """All live rows, or those before a batch was applied. The newest row of a key is that of the
        highest `order`, deletes included, and among equals that of the latest batch."""
        written = self.spark.read.parquet(self.path)
        if before_batch is not None:
            written = written.filter(F.col("batch") < before_batch)
        rest = [c for c in written.columns if c not in self.keys and c != "batch"]
        age = [self.order, "batch"] if self.order else ["batch"]
        newest = written.groupBy(*self.keys).agg(
            F.max_by(F.struct(*rest), F.struct(*age)).alias("_row")).select(*self.keys, "_row.*")
        return newest.filter(~F.col("_gone")).drop("_gone")

    def changes_of(self, batch_id: int) -> DataFrame:
        """What a batch changed, as +I, -U, +U and -D rows; only keys it touched are compared."""
        touched = self.spark.read.parquet(f"{self.path}/batch={batch_id}").select(*self.keys)
        old = self.current(batch_id).join(touched, self.keys, "left_semi")
        new = self.current(batch_id + 1).join(touched, self.keys, "left_semi")
        return as_changelog(old, new, self.keys)


def document_id(keys: Sequence[str], delimiter: str = "_"):
    """The id of a document made of several key columns; different keys have different ids."""
    return key_text([F.col(k) for k in keys], delimiter)


def upsert_stream(
    df: DataFrame, table: KeyedTable, checkpoint: str, mode: str = "update", op: str | None = None
) -> DataStreamWriter:
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda rows, batch_id: table.upsert(rows, batch_id, op)))


def merge_statement(dialect: str, table: str, stage: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """The statement that moves a staged batch into a database table, by key."""
    names = ", ".join(columns)
    others = [c for c in columns if c not in keys]
    if dialect == "mysql":
        updates = ", ".join(f"{c} = VALUES({c})" for c in others)
        return (f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} "
                f"ON DUPLICATE KEY UPDATE {updates}")
    if dialect == "mysql-replace":
        return f"REPLACE INTO {table} ({names}) SELECT {names} FROM {stage}"
    if dialect == "postgresql":
        updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in others)
        return (f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} "
                f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}")
    if dialect == "oracle":
        on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
        updates = ", ".join(f"t.{c} = s.{c}" for c in others)
        values = ", ".join(f"s.{c}" for c in columns)
        return (f"MERGE INTO {table} t USING {stage} s ON ({on}) "
                f"WHEN MATCHED THEN UPDATE SET {updates} "
                f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")
    raise ValueError(f"unknown dialect {dialect!r}")


def stage_batch(
    rows: DataFrame, url: str, stage: str, keys: Sequence[str], order: str,
    batch_rows: int = 1000, **options: str,
) -> None:
    """Write the last row per key of a batch to a staging table over JDBC."""
    rest = F.struct(*[c for c in rows.columns if c not in keys])
    last = rows.groupBy(*keys).agg(F.max_by(rest, order).alias("_row")).select(*keys, "_row.*")
    last.write.mode("overwrite").options(batchsize=batch_rows, truncate="true", **options).jdbc(
        url, stage)


def in_chunks(write: Callable[[list, int], None], size: int = 10) -> Callable[[DataFrame, int], None]:
    """A batch function that hands rows to `write` in lists of at most `size`, inside the tasks.

    `write(rows, batch_id)` may see a batch again after a failure and should then overwrite it.
    """

    def flush(rows: DataFrame, batch_id: int) -> None:
        def work(partition) -> None:
            chunk = []
            for row in partition:
                chunk.append(row)
                if len(chunk) == size:
                    write(chunk, batch_id)
                    chunk = []
            if chunk:
                write(chunk, batch_id)

        rows.foreachPartition(work)

    return flush
