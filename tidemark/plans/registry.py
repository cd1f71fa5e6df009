"""Where the runnable queries are collected, and the given tables they read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure


class Tables:
    """The given tables, plus the event streams the jobs read out of `events`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    def stream(
        self, name: str, files_per_batch: int | None = None, zoned: bool = True
    ) -> DataFrame:
        """The same table as a stream of files; `zoned` turns its times into timestamps, which
        watermarks require.

        The bracket makes the path a pattern, which a stream accepts for a file and a folder alike.
        """
        schema = self.read(name).schema
        reader = self.spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        rows = reader.parquet(f"{self.folder}/{name}.parque[t]")
        times = [f.name for f in schema if f.dataType.simpleString() == "timestamp_ntz"]
        return rows.withColumns({c: F.col(c).cast("timestamp") for c in times if zoned})

    def of_type(self, *types: str) -> DataFrame:
        return self.events.filter(F.col("event_type").isin(*types))

    @property
    def views(self) -> DataFrame:
        """Page views with the viewed item."""
        return self.of_type("view").withColumn("item", item_of(F.col("props")))


def item_of(props):
    return F.get_json_object(props, "$.k").cast("int")


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None
    as_text: tuple[str, ...] = ()


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, as_text: tuple[str, ...] = ()):
    """Register a query with its checking SQL. Columns named in `as_text` leave as text: dates and
    whole numbers that may be null reach Python in different forms from the two engines."""
    if sql and as_text and "REPLACE (" not in sql:
        texts = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in as_text)
        sql = f"SELECT * REPLACE ({texts}) FROM ({sql})"

    def keep(run: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")

        def with_text(t: Tables) -> DataFrame:
            return run(t).withColumns({d: F.col(d).cast("string") for d in as_text})

        QUERIES[name] = Query(name, with_text if as_text else run, sql, as_text)
        return run

    return keep
