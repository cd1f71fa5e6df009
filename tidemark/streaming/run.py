"""Running a stream over bounded input to its end.

A stream keeps windows and timers open until later rows move the watermark past them. Where the
input ends, `StreamRun` restarts the query once more with a single row far in the future, which
closes everything and is itself dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

END_OF_TIME = "2200-01-01 00:00:00"


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as zone-less times, as the given tables store them."""
    times = [n for n, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in times})


def _filler(kind: T.DataType):
    """A value for the closing row; null would fail the not-null checks Spark adds to joins."""
    if isinstance(kind, T.BooleanType):
        return False
    if isinstance(kind, T.IntegralType):
        return 0
    if isinstance(kind, T.FractionalType):
        return Decimal(0) if isinstance(kind, T.DecimalType) else 0.0
    if isinstance(kind, T.StringType):
        return ""
    if isinstance(kind, T.DateType):
        return date(1970, 1, 1)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return datetime(1970, 1, 1)
    return None


class StreamRun:
    """A stream's folder with its checkpoint and output. A new one by default; with `path` an earlier
    run's, which goes on where that one stopped."""

    def __init__(self, spark: SparkSession, label: str, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, label)
        self._flushes: list[tuple[str, DataFrame, str]] = []

    def with_event_time(self, rows: DataFrame, ts: str, delay: str) -> DataFrame:
        """Set the watermark on `ts`, prepared for the closing row.

        Row filters belong before this call: Spark would move later ones below the watermark, where
        they would also drop the closing row.
        """
        folder = f"{self.path}/flush-{len(self._flushes)}"
        self.spark.createDataFrame([], rows.schema).write.mode("ignore").parquet(folder)
        self._flushes.append((folder, rows, ts))
        closing = self.spark.readStream.schema(rows.schema).parquet(folder)
        return (
            rows.unionByName(closing)
            .withWatermark(ts, delay)
            .filter(F.col(ts) < F.lit(END_OF_TIME).cast("timestamp"))
        )

    def _drive(self, start: Callable, arrivals: Sequence[Callable[[], None]] = (), close: bool = True) -> None:
        """Run over all there is, or once after each of some arrivals, then over the closing rows."""
        # The closing run advances the watermark anyway; until then batches without rows gain nothing, and
        # state with a time to live would ask for ever more of them.
        empty_batches = "spark.sql.streaming.noDataMicroBatches.enabled"
        before = self.spark.conf.get(empty_batches)
        self.spark.conf.set(empty_batches, "false")
        try:
            for arrive in arrivals or [lambda: None]:
                arrive()
                start().awaitTermination()
        finally:
            self.spark.conf.set(empty_batches, before)
        if not self._flushes or not close:
            return
        end = datetime.fromisoformat(END_OF_TIME).replace(tzinfo=timezone.utc)
        for folder, rows, ts in self._flushes:
            row = tuple(end if f.name == ts else _filler(f.dataType) for f in rows.schema)
            one = self.spark.createDataFrame([row], rows.schema).coalesce(1)
            one.write.mode("append").parquet(folder)
        start().awaitTermination()

    def to_files(
        self, result: DataFrame, arrivals: Sequence[Callable[[], None]] = (), close: bool = True
    ) -> DataFrame:
        """Append the result to files, exactly once per row, and return them as a table.

        `arrivals` bring new input, each for a batch of its own. Without `close` the stream only pauses:
        what waits for later rows goes on waiting, here or in a later run over the same folder.
        """
        out = f"{self.path}/out"
        writer = (
            result.writeStream.format("parquet").outputMode("append")
            .option("path", out).option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True))
        self._drive(writer.start, arrivals, close)
        return self.spark.read.schema(result.schema).parquet(out)

    def for_each_batch(
        self, result: DataFrame, work: Callable[[DataFrame, int], None], mode: str = "append",
        arrivals: Sequence[Callable[[], None]] = (),
    ) -> None:
        """Call `work(rows, batch_id)` per batch. A batch may be repeated after a failure."""
        writer = (
            result.writeStream.outputMode(mode).foreachBatch(work)
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True))
        self._drive(writer.start, arrivals)

    def to_batch_files(
        self, result: DataFrame, change: Callable[[DataFrame], DataFrame], schema: str
    ) -> DataFrame:
        """Write `change(rows)` of each batch to its own folder, replacing it when repeated."""
        out = f"{self.path}/out"
        self.for_each_batch(
            result,
            lambda rows, batch_id: change(rows).write.mode("overwrite").parquet(
                f"{out}/batch={batch_id}"))
        return self.spark.read.schema(schema).parquet(f"{out}/batch=*")
