"""Kafka as source and sink. Needs Spark's Kafka package on the cluster."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import key_text
from tidemark.operators.rows import parse_json, parse_lines


def starting_offsets(start: str | dict[str, dict[int, int]]) -> str:
    """'earliest', 'latest', or offsets per topic and partition as Spark's JSON."""
    if isinstance(start, str):
        return start
    return json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in start.items()})


def source_options(
    servers: str, topics: str, start: str | dict = "latest", group: str | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": starting_offsets(start),
    }
    if group:
        options["kafka.group.id"] = group
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(spark: SparkSession, stream: bool = True, **options) -> DataFrame:
    """Messages as `value` text. A restarted stream resumes from its checkpoint."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    return reader.options(**source_options(**options)).load().select(
        F.col("value").cast("string").alias("value"))


def decode(messages: DataFrame, schema: str, format: str = "json") -> DataFrame:
    """Typed columns from message text; JSON records that do not parse are dropped."""
    return parse_json(messages, schema) if format == "json" else parse_lines(messages, schema)


def encode(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows as JSON messages, keyed when key columns are given (for topics that are upserted)."""
    value = F.to_json(F.struct("*")).alias("value")
    if not keys:
        return df.select(value)
    return df.select(key_text([F.col(k) for k in keys]).alias("key"), value)


def write_topic(df: DataFrame, servers: str, topic: str, keys: tuple[str, ...] = ()):
    """A stream writer for a topic; delivery is at least once, so readers dedupe by key."""
    return (
        encode(df, keys).writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic}))
