"""Readers for text, delimited and JSON files, rows in code, and declared tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _reader(spark: SparkSession, stream: bool, files_per_batch: int | None):
    if not stream:
        return spark.read
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def read_lines(
    spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Lines of a file, a directory or a remote location, as `value`."""
    return _reader(spark, stream, files_per_batch).text(path)


def read_delimited(
    spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",",
    on_error: str = "FAILFAST", stream: bool = False, files_per_batch: int | None = None,
) -> DataFrame:
    reader = _reader(spark, stream, files_per_batch)
    return reader.schema(schema).options(sep=sep, mode=on_error).csv(path)


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    return spark.readStream.format("socket").options(host=host, port=port).load()


def read_table(spark: SparkSession, name: str, stream: bool = False) -> DataFrame:
    """A table of the session's catalog."""
    return spark.readStream.table(name) if stream else spark.table(name)


@dataclass(frozen=True)
class TableSpec:
    """A declared table: schema, format, location, and how its event time is found.

    `computed` adds columns from SQL expressions, such as a timestamp from epoch milliseconds;
    `event_time` and `delay` set the watermark when the table is read as a stream.
    """

    name: str
    schema: str
    format: str
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    computed: dict[str, str] = field(default_factory=dict)
    event_time: str | None = None
    delay: str = "0 seconds"

    def read(self, spark: SparkSession, stream: bool = False) -> DataFrame:
        reader = (spark.readStream if stream else spark.read).format(self.format)
        reader = reader.options(**self.options).schema(self.schema)
        df = reader.load(self.path) if self.path else reader.load()
        df = df.withColumns({n: F.expr(e) for n, e in self.computed.items()})
        if stream and self.event_time:
            df = df.withWatermark(self.event_time, self.delay)
        return df

    def register(self, spark: SparkSession, stream: bool = False) -> DataFrame:
        df = self.read(spark, stream)
        df.createOrReplaceTempView(self.name)
        return df
