"""Row-level work: parsing, routing to side outputs, merging streams, repartitioning."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_lines(
    lines: DataFrame, schema: str, column: str = "value", sep: str = ",", on_error: str = "FAILFAST"
) -> DataFrame:
    """Delimited text to typed columns. Bad lines raise, or vanish with on_error="DROPMALFORMED"."""
    keep_bad = on_error == "FAILFAST"
    options = {"sep": sep, "mode": "FAILFAST" if keep_bad else "PERMISSIVE"}
    if keep_bad:
        return lines.select(F.from_csv(column, schema, options).alias("r")).select("r.*")
    parsed = F.from_csv(
        column, f"{schema}, _bad string", {**options, "columnNameOfCorruptRecord": "_bad"})
    return _without_bad(lines, column, parsed, ())


def _without_bad(df: DataFrame, column: str, parsed: Column, keep: Sequence[str]) -> DataFrame:
    """Expand a parsed record; bad, blank and null ones go. A generator keeps the later filter from being
    pushed down, where it would parse every record a second time."""
    present = df.filter(F.trim(F.regexp_replace(column, r"\s+", " ")) != "")
    whole = F.filter(F.array(parsed), lambda r: r.isNotNull())
    return present.select(*keep, F.inline(whole)).filter("_bad is null").drop("_bad")


def parse_json(
    records: DataFrame, schema: str, column: str = "value", on_error: str = "DROPMALFORMED",
    keep: Sequence[str] = (),
) -> DataFrame:
    """JSON text to typed columns beside the `keep` columns; bad records are dropped or raise."""
    if on_error == "FAILFAST":
        parsed = records.select(*keep, F.from_json(column, schema, {"mode": "FAILFAST"}).alias("r"))
        return parsed.select(*keep, "r.*")
    options = {"columnNameOfCorruptRecord": "_bad"}
    parsed = F.from_json(column, f"{schema}, _bad string", options)
    return _without_bad(records, column, parsed, keep)


def words(lines: DataFrame, column: str, pattern: str = "[ \\n\\t\\r]+") -> DataFrame:
    """One row per non-empty word."""
    return lines.select(F.explode(F.split(column, pattern)).alias("word")).filter("word <> ''")


def route(df: DataFrame, tags: dict[str, Column], otherwise: str = "main") -> DataFrame:
    """Add `tag`: the first matching condition names the output a row belongs to."""
    tag: Column | None = None
    for name, condition in tags.items():
        tag = F.when(condition, name) if tag is None else tag.when(condition, name)
    return df.withColumn("tag", F.lit(otherwise) if tag is None else tag.otherwise(otherwise))


def branch(routed: DataFrame, tag: str) -> DataFrame:
    return routed.filter(F.col("tag") == tag).drop("tag")


def connect(left: DataFrame, right: DataFrame, left_map: dict, right_map: dict) -> DataFrame:
    """Bring two differently typed inputs to one shape and merge them, keeping duplicates."""
    return left.select(*[c.alias(n) for n, c in left_map.items()]).unionByName(
        right.select(*[c.alias(n) for n, c in right_map.items()]))


def with_resource(
    df: DataFrame, open_resource: Callable, work: Callable, close_resource: Callable, schema
) -> DataFrame:
    """Map batches with something opened once per task and closed after it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_resource()
        try:
            for batch in batches:
                yield work(resource, batch)
        finally:
            close_resource(resource)

    return df.mapInPandas(run, schema)


def spread(df: DataFrame, how: str, n: int, *keys: str) -> DataFrame:
    """Repartition by name: by_key, round_robin (even spread), fewer (no shuffle), or single."""
    if how == "by_key":
        return df.repartition(n, *keys)
    if how == "round_robin":
        return df.repartition(n)
    if how == "fewer":
        return df.coalesce(n)
    if how == "single":
        return df.repartition(1)
    raise ValueError(f"unknown repartitioning {how!r}")
