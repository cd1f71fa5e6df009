"""Row-change feeds: envelopes, folding them to current tables, deriving changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rows import parse_json


def log_envelope(row: str) -> str:
    """Schema of a replication-log record whose rows have the columns `row` (DDL)."""
    return (
        "`table` string, op_type string, op_ts timestamp_ntz, current_ts timestamp_ntz, "
        f"pos string, primary_keys array<string>, before struct<{struct_fields(row)}>, "
        f"after struct<{struct_fields(row)}>"
    )


def capture_envelope(row: str) -> str:
    """Schema of a database-capture record: operation, data, database, table."""
    return f"operation string, data struct<{struct_fields(row)}>, `database` string, `table` string"


def struct_fields(ddl: str) -> str:
    """`a int, b decimal(10,2)` to the `a: int, ...` form a struct type takes."""
    fields, depth, start = [], 0, 0
    for i, c in enumerate(f"{ddl},"):
        depth += (c in "(<") - (c in ")>")
        if c == "," and depth == 0:
            name, kind = ddl[start:i].strip().split(None, 1)
            fields.append(f"{name}: {kind}")
            start = i + 1
    return ", ".join(fields)


def parse_log(
    records: DataFrame, row: str, column: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Replication-log JSON to one flat row per change; a delete keeps its `before` values.

    `data` holds the row, `op_type` is I, U or D, and `op_ts, pos` order the changes.
    """
    parsed = parse_json(records, log_envelope(row), column, keep=keep)
    is_delete = F.col("op_type") == "D"
    return parsed.withColumn("data", F.when(is_delete, F.col("before")).otherwise(F.col("after")))


# Names databases give to a change, mapped to the letter used here.
OPERATIONS = {
    "read": "I", "create": "I", "insert": "I", "update": "U", "delete": "D",
    "r": "I", "c": "I", "i": "I", "u": "U", "d": "D",
}


def parse_capture(
    records: DataFrame, row: str, column: str = "value", keep: Sequence[str] = (),
    on_unknown: str = "FAILFAST",
) -> DataFrame:
    """Database-capture JSON to rows with `data` and `op_type`.

    An operation that is missing or not among OPERATIONS stops the job, or with
    on_unknown="PERMISSIVE" stays as a row whose `op_type` is null, for a bad-record output.
    """
    parsed = parse_json(records, capture_envelope(row), column, keep=keep)
    letters = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])
    letter = letters[F.lower("operation")]
    if on_unknown == "FAILFAST":
        told = F.concat(F.lit("unknown operation: "), F.coalesce("operation", F.lit("null")))
        letter = F.coalesce(letter, F.raise_error(told).cast("string"))
    return parsed.withColumn("op_type", letter).drop("operation")


def fold_to_current(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op_type",
    keep_deletes: bool = False,
) -> DataFrame:
    """The last state of every key; deleted keys vanish unless kept.

    The newest change per key is a mergeable aggregate, so a key with many changes is reduced to
    one row per task before it is shuffled.
    """
    rest = [c for c in changes.columns if c not in keys]
    newest = changes.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")
    return newest if keep_deletes else newest.filter(~F.col(op).eqNullSafe("D")).drop(op, *order)


def enrich(
    orders: DataFrame, others: Sequence[tuple[DataFrame, str, str]]
) -> DataFrame:
    """Left join further current tables, each given with the column pair to match on."""
    for table, left_key, right_key in others:
        orders = orders.join(table, orders[left_key] == table[right_key], "left")
        if left_key != right_key:
            orders = orders.drop(table[right_key])
    return orders


def as_changelog(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes between two states: `row_kind` +I, -U, +U or -D beside the affected row."""
    rest = [c for c in new.columns if c not in keys]
    was = old.select(*keys, F.struct(*rest).alias("_old"))
    now = new.select(*keys, F.struct(*rest).alias("_new"))
    both = was.join(now, list(keys), "full_outer")
    changed = both.filter(~F.col("_old").eqNullSafe(F.col("_new")))

    def entry(kind: str, row: str):
        return F.struct(F.lit(kind).alias("row_kind"), F.col(row).alias("row"))

    kinds = (
        F.when(F.col("_old").isNull(), F.array(entry("+I", "_new")))
        .when(F.col("_new").isNull(), F.array(entry("-D", "_old")))
        .otherwise(F.array(entry("-U", "_old"), entry("+U", "_new")))
    )
    return changed.withColumn("_c", F.explode(kinds)).select("_c.row_kind", *keys, "_c.row.*")
