"""User functions: SQL functions Spark inlines, table functions, user-defined aggregates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# SQL bodies are expanded into the calling query, so these cost no more than built-ins.
SQL_FUNCTIONS = {
    "text_length": "text_length(content STRING) RETURNS INT RETURN length(content)",
    "mask_digits": r"""mask_digits(content STRING, head INT DEFAULT 4, tail INT DEFAULT 4)
        RETURNS STRING
        RETURN coalesce(regexp_replace(content,
            concat('^(\\d{', head, '})\\d+(\\d{', tail, '})$'),
            concat('$1', repeat('*', length(content) - head - tail), '$2')), '')""",
    "split_words": """split_words(content STRING, sep STRING DEFAULT '_')
        RETURNS TABLE (word STRING)
        RETURN SELECT explode(split(content, sep))""",
}


def register(spark: SparkSession) -> None:
    """Make the user functions callable from SQL in this session."""
    for definition in SQL_FUNCTIONS.values():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")
    spark.udtf.register("word_lengths", word_lengths())
    spark.udf.register("text_length_arrow", text_length_arrow())


def text_length_arrow():
    """The Arrow form of a scalar user function, for logic SQL cannot express."""

    @F.pandas_udf(T.IntegerType())
    def length(content: pd.Series) -> pd.Series:
        return content.str.len().astype("Int32")

    return length


def word_lengths():
    """A table function written in Python: one row per word with its length. Rows travel in Arrow
    batches; a function over whole batches cannot stand in a lateral join."""

    @F.udtf(returnType="word string, n int", useArrow=True)
    class WordLengths:
        def eval(self, content: str, sep: str):
            if content is not None:
                for word in content.split(sep):
                    yield word, len(word)

    return WordLengths


class UserAggregate:
    """An aggregate defined by a user: accumulators are built per task and merged per key.

    `accumulator` and `result` are DDL column lists; an accumulator is a tuple in that order.
    """

    accumulator: str
    result: str

    def create(self) -> tuple:
        raise NotImplementedError

    def add(self, acc: tuple, values: pd.Series) -> tuple:
        raise NotImplementedError

    def retract(self, acc: tuple, values: pd.Series) -> tuple:
        raise NotImplementedError(f"{type(self).__name__} cannot take rows back")

    def merge(self, left: tuple, right: tuple) -> tuple:
        raise NotImplementedError

    def emit(self, acc: tuple) -> list[tuple]:
        """Result rows: one for a plain aggregate, several for a table aggregate."""
        raise NotImplementedError


class WeightedAverage(UserAggregate):
    accumulator = "total double, n long"
    result = "average double"

    def create(self):
        return 0.0, 0

    def add(self, acc, values):
        return acc[0] + float(values.sum()), acc[1] + int(values.count())

    def retract(self, acc, values):
        return acc[0] - float(values.sum()), acc[1] - int(values.count())

    def merge(self, left, right):
        return left[0] + right[0], left[1] + right[1]

    def emit(self, acc):
        return [(acc[0] / acc[1],)] if acc[1] else []


class TopValues(UserAggregate):
    accumulator = "best array<double>"
    result = "value double, rk int"

    def __init__(self, n: int = 3):
        self.n = n

    def create(self):
        return ([],)

    def add(self, acc, values):
        return (sorted([*acc[0], *values.nlargest(self.n)], reverse=True)[: self.n],)

    def merge(self, left, right):
        return (sorted([*left[0], *right[0]], reverse=True)[: self.n],)

    def emit(self, acc):
        return [(value, i + 1) for i, value in enumerate(acc[0])]


# Keys a task folds at once; beyond it, it hands on what it has. Nothing is lost, only shuffled earlier.
MAX_OPEN_KEYS = 100_000


def aggregate_with(
    df: DataFrame, keys: Sequence[str], value: str, agg: UserAggregate, sign: str | None = None,
    max_open_keys: int = MAX_OPEN_KEYS,
) -> DataFrame:
    """Run a user aggregate. With `sign`, rows whose sign is negative are taken back.

    Each task first folds its own rows, so one key reaches the merge as a few accumulators per task
    however many rows it has. The merge reads them sorted by key, one at a time. Keys stay Arrow or
    Python values: nulls, large numbers and times come out as they went in.
    """
    keys = list(keys)
    key_fields = [df.schema[k] for k in keys]
    acc_fields = T.StructType.fromDDL(agg.accumulator).fields
    out_fields = T.StructType.fromDDL(agg.result).fields
    acc_names = [f.name for f in acc_fields]
    out_names = [f.name for f in out_fields]
    acc_schema = to_arrow_schema(T.StructType([*key_fields, *acc_fields]))
    out_schema = to_arrow_schema(T.StructType([*key_fields, *out_fields]))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_keys: dict[tuple, tuple] = {}
        for batch in batches:
            values = batch[value].to_pandas()
            signs = batch[sign].to_pandas() if sign else None
            rows: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*[batch[k].to_pylist() for k in keys], strict=True)):
                rows.setdefault(key, []).append(i)
            for key, at in rows.items():
                acc = open_keys.get(key) or agg.create()
                part = values.iloc[at]
                if signs is None:
                    acc = agg.add(acc, part)
                else:
                    plus = signs.iloc[at] >= 0
                    acc = agg.add(acc, part[plus]) if plus.any() else acc
                    acc = agg.retract(acc, part[~plus]) if not plus.all() else acc
                open_keys[key] = acc
            if len(open_keys) > max_open_keys:
                yield _batch(((*k, *acc) for k, acc in open_keys.items()), acc_schema)
                open_keys = {}
        if open_keys:
            yield _batch(((*k, *acc) for k, acc in open_keys.items()), acc_schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, agg.create()
        for batch in batches:
            done: list[tuple] = []
            columns = [batch[c].to_pylist() for c in (*keys, *acc_names)]
            for row in zip(*columns, strict=True):
                key = row[:len(keys)]
                if now is not None and key != now:
                    done += [(*now, *r) for r in agg.emit(total)]
                    total = agg.create()
                now, total = key, agg.merge(total, row[len(keys):])
            if done:
                yield _batch(done, out_schema)
        if now is not None:
            yield _batch([(*now, *r) for r in agg.emit(total)], out_schema)

    columns = [*keys, value] + ([sign] if sign else [])
    accs = df.select(*columns).mapInArrow(partial, T.StructType([*key_fields, *acc_fields]))
    together = accs.repartition(*keys).sortWithinPartitions(*keys)
    return together.mapInArrow(finish, T.StructType([*key_fields, *out_fields])).select(*keys, *out_names)


def _batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
