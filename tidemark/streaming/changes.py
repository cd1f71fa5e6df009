"""Streams that change their answers: joins of change feeds, joins with idle retention, full groups."""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PLUS = ("+I", "+U")
# Groups to which the keys of change feeds are dealt. State knows them, so their number has to stay.
SHARDS = 512


def _ddl(df: DataFrame, columns: Sequence[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in columns)


class Entries:
    """Entries of many keys in the state of one shard, in the order of their keys.

    They lie in chunks of up to 2 * CHUNK entries, each one value of a map; one more value has the first key of
    each chunk. So a batch reads and writes the chunks in which its keys are, once each if it asks for them in
    order, and not a value for every key. Keys are pairs of texts, a group and a member of it.
    """

    CHUNK = 512

    def __init__(self, handle: StatefulProcessorHandle):
        self._known = handle.getValueState("known", "chunks binary")
        self._chunks = handle.getMapState("chunks", "n long", "entries binary")

    def open(self) -> None:
        """Begin with the shard that is handled now."""
        known = self._known.get()
        self._firsts, self._numbers, self._next = pickle.loads(known[0]) if known else ([], [], 0)
        self._at, self._held, self._changed, self._moved = -1, {}, False, False

    def get(self, key: tuple[str, str]):
        return self._chunk(key).get(key)

    def put(self, key: tuple[str, str], value) -> None:
        self._chunk(key)[key] = value
        self._changed = True

    def remove(self, key: tuple[str, str]) -> None:
        if self._chunk(key).pop(key, None) is not None:
            self._changed = True

    def of_group(self, group: str) -> Iterator[tuple[tuple[str, str], tuple]]:
        """The entries of a group, a chunk at a time; nothing may be changed meanwhile."""
        key = (group, "")
        while True:
            held = self._chunk(key)
            key = self._firsts[self._at + 1] if self._at + 1 < len(self._firsts) else None
            for found in held.items():
                if found[0][0] == group:
                    yield found
            if key is None or key[0] != group:
                return

    def save(self) -> None:
        self._store()
        self._at = -1
        if self._moved:
            self._known.update((pickle.dumps((self._firsts, self._numbers, self._next)),))

    def _chunk(self, key: tuple[str, str]) -> dict:
        if self._at < 0 or not self._here(key):
            self._store()
            # What comes before the first chunk goes into it.
            self._at = max(bisect_right(self._firsts, key) - 1, 0)
            self._held = (
                pickle.loads(self._chunks.getValue((self._numbers[self._at],))[0]) if self._numbers else {})
        return self._held

    def _here(self, key: tuple[str, str]) -> bool:
        after = self._at + 1
        return (self._at == 0 or self._firsts[self._at] <= key) and (
            after >= len(self._firsts) or key < self._firsts[after])

    def _store(self) -> None:
        if not self._changed:
            return
        self._changed = False
        at, entries = self._at, self._held
        if at < len(self._numbers) and 0 < len(entries) <= 2 * self.CHUNK:
            self._chunks.updateValue((self._numbers[at],), (pickle.dumps(entries),))
            return
        # A chunk is new, too long or empty.
        self._moved = True
        keys, free = sorted(entries), self._numbers[at:at + 1]
        size = len(keys) if len(keys) <= 2 * self.CHUNK else self.CHUNK
        firsts, numbers = keys[::size] if keys else [], []
        for low in range(0, len(keys), size or 1):
            if free:
                numbers.append(free.pop())
            else:
                numbers.append(self._next)
                self._next += 1
            piece = {k: entries[k] for k in keys[low:low + size]}
            self._chunks.updateValue((numbers[-1],), (pickle.dumps(piece),))
        for number in free:
            self._chunks.removeKey((number,))
        self._firsts[at:at + 1], self._numbers[at:at + 1] = firsts, numbers
        self._at = -1


def _mark(text: str | None) -> str:
    """A text as part of a key: null comes before all texts, and the empty mark before it."""
    return "-" if text is None else "=" + text


class NetChanges(StatefulProcessor):
    """What a batch of changes did to each row of a shard: its old and its new form.

    A change is older than another if its `seq` is smaller, whatever batch it comes in; a change that is
    older than the last one known, a delete included, does nothing.
    """

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = Entries(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = next(rows, None)
        if first is None:
            return
        fields = first.__fields__
        side, row_key, op_type, seq = (fields.index(c) for c in ("side", "row_key", "op_type", "seq"))
        at = [fields.index(c) for c in self.columns]
        newest: dict[tuple[str, str], Row] = {}
        for row in (first, *rows):
            own = (_mark(row[side]), _mark(row[row_key]))
            if own not in newest or row[seq] > newest[own][seq]:
                newest[own] = row
        named, last = Row("side", "row_key", "row_kind", *self.columns), self._last
        last.open()
        for own in sorted(newest):
            row, known = newest[own], last.get(own)
            if known is not None and row[seq] <= known[0]:
                continue
            old = known[1] if known is not None else None
            new = None if row[op_type] == "D" else tuple(row[i] for i in at)
            last.put(own, (row[seq], new))
            if old == new:
                continue
            kinds = ("-D", "+I") if old is None or new is None else ("-U", "+U")
            for kind, values in zip(kinds, (old, new), strict=True):
                if values is not None:
                    yield named(row[side], row[row_key], kind, *values)
        last.save()

    def close(self) -> None:
        pass


class JoinedChanges(StatefulProcessor):
    """The left rows of the link values of a shard, each beside the right row of its value or nothing.

    A left row's change gives that row's change; a change of the right row takes back and gives anew every
    left row it stands beside. A batch costs what it changes. The left rows of a link value lie side by side,
    behind the right row of that value.
    """

    def __init__(self, left: Sequence[str], right: Sequence[str]):
        self.left, self.right = list(left), list(right)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._rows = Entries(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Of each link value the left rows that go, those that come, and the new right row.
        changes: dict[str, list] = {}
        for row in rows:
            change = changes.setdefault(_mark(row["_link"]), [[], [], None])
            if row["side"] == "right":
                if change[2] is None or row["row_kind"] in PLUS:
                    change[2] = row
            else:
                change[row["row_kind"] in PLUS].append((_mark(row["row_key"]), row))
        self._rows.open()
        for link in sorted(changes):
            yield from self._link(link, *changes[link])
        self._rows.save()

    def _link(self, link: str, gone: list, came: list, right: Row | None) -> Iterator[Row]:
        named, held, nothing = Row("row_kind", *self.left, *self.right), self._rows, (None,) * len(self.right)
        beside = (link, "")
        was = held.get(beside) or nothing
        for row_key, row in sorted(gone, key=itemgetter(0)):
            held.remove((link, row_key))
            yield named(row["row_kind"], *(row[c] for c in self.left), *was)
        now = was
        if right is not None and link != _mark(None):  # nothing equals a null link
            if right["row_kind"] in PLUS:
                now = tuple(right[c] for c in self.right)
                held.put(beside, now)
            else:
                now = nothing
                held.remove(beside)
            for own, left in held.of_group(link):
                if own != beside:
                    yield named("-U", *left, *was)
                    yield named("+U", *left, *now)
        for row_key, row in sorted(came, key=itemgetter(0)):
            left = tuple(row[c] for c in self.left)
            held.put((link, row_key), left)
            yield named(row["row_kind"], *left, *now)

    def close(self) -> None:
        pass


def _shard(*columns: str | Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SHARDS))


def retracting_join(
    changes: DataFrame, left_key: str, link: str, right_key: str, left: Sequence[str], right: Sequence[str]
) -> DataFrame:
    """The left join of two change feeds as a feed of changes itself.

    `changes` holds both sides, told apart by `side` (left or right), with `op_type` (D deletes), `seq` (text
    that orders the changes of a row), the keys, `link` (the right key that a left row points to) and the
    other columns. Returns `row_kind` (+I, -U, +U, -D) with the left key, `left` and `right` columns. A left
    row that moves to another link leaves one key of the state and comes to another, in one batch.

    Keys are told apart by their text. Spark's state gives a key at a time to Python, which costs far more than
    the work on it, so the keys are dealt to SHARDS groups.
    """
    columns = list(dict.fromkeys([left_key, link, *left, right_key, *right]))
    row_key = F.when(F.col("side") == "left", F.col(left_key).cast("string")).otherwise(
        F.col(right_key).cast("string"))
    keyed = changes.select("side", row_key.alias("row_key"), "op_type", "seq", *columns)
    fields = [keyed.schema[c] for c in columns]
    text = [T.StructField(c, T.StringType()) for c in ("side", "row_key", "row_kind")]
    net = keyed.withColumn("_shard", _shard("side", "row_key")).groupBy("_shard").transformWithState(
        NetChanges(columns), T.StructType([*text, *fields]), "append", "None")
    at = F.when(F.col("side") == "left", F.col(link)).otherwise(F.col(right_key))
    if dict(net.select(at.alias("at")).dtypes)["at"] in ("float", "double"):
        at = at + F.lit(0.0)  # of two zeros one text
    lefts, rights = [left_key, *left], list(right)
    schema = T.StructType([T.StructField("row_kind", T.StringType()), *[keyed.schema[c] for c in [*lefts, *rights]]])
    # Rows without a link stand beside nothing, so they need not lie together.
    linked = net.withColumn("_link", at.cast("string")).withColumn("_shard", _shard(F.coalesce("_link", "row_key")))
    return linked.groupBy("_shard").transformWithState(
        JoinedChanges(lefts, rights), schema, "append", "None")


def live_rows(changelog: DataFrame) -> DataFrame:
    """What is left of a feed of changes, in whatever order it is read: rows given more often than taken back."""
    rest = [c for c in changelog.columns if c != "row_kind"]
    sign = F.when(F.col("row_kind").isin(*PLUS), 1).otherwise(-1)
    return changelog.groupBy(*rest).agg(F.sum(sign).alias("_n")).filter("_n > 0").drop("_n")


class RetainedPairs(StatefulProcessor):
    """Pairs of rows of one key from two streams, as long as both are remembered: a row is forgotten a while
    (processing time) after it came."""

    def __init__(self, key: Sequence[str], left: Sequence[str], left_ddl: str, right: Sequence[str],
                 right_ddl: str, ttl_ms: int):
        self.names = [*key, *left, *right]
        self.sides = {"left": (list(left), left_ddl), "right": (list(right), right_ddl)}
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._kept = {
            side: handle.getListState(side, ddl, ttlDurationMs=self.ttl_ms) for side, (_, ddl) in self.sides.items()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[str, list[tuple]] = {"left": [], "right": []}
        for row in rows:
            new[row["_side"]].append(tuple(row[c] for c in self.sides[row["_side"]][0]))
        named = Row(*self.names)
        if new["right"]:
            for left in self._kept["left"].get():
                for right in new["right"]:
                    yield named(*key, *left, *right)
        if new["left"]:
            for right in self._kept["right"].get():
                for left in new["left"]:
                    yield named(*key, *left, *right)
        for left in new["left"]:
            for right in new["right"]:
                yield named(*key, *left, *right)
        for side, some in new.items():
            if some:
                self._kept[side].appendList(some)

    def close(self) -> None:
        pass


def retained_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ttl_ms: int) -> DataFrame:
    """Inner join of two streams without a bound in event time: state that is older than `ttl_ms` goes.

    The columns of both sides must differ but for the keys. Rows with a null key join nothing.
    """
    names = {"left": [c for c in left.columns if c not in keys], "right": [c for c in right.columns if c not in keys]}
    both = left.withColumn("_side", F.lit("left")).unionByName(
        right.withColumn("_side", F.lit("right")), allowMissingColumns=True).dropna(subset=list(keys))
    schema = T.StructType([*[left.schema[k] for k in keys], *[left.schema[c] for c in names["left"]],
                           *[right.schema[c] for c in names["right"]]])
    pairs = RetainedPairs(keys, names["left"], _ddl(left, names["left"]), names["right"],
                          _ddl(right, names["right"]), ttl_ms)
    return both.groupBy(*keys).transformWithState(pairs, schema, "append", "ProcessingTime")


class FullGroups(StatefulProcessor):
    """Rows of a shard in groups of exactly `size`; what is left over waits, over restarts too, and comes as a
    shorter group when the stream is closed."""

    def __init__(self, names: Sequence[str], ddl: str, order: str, size: int, closes_ms: int):
        self.names, self.ddl, self.size, self.closes_ms = list(names), ddl, size, closes_ms
        self.order = self.names.index(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getListState("rows", self.ddl)
        self._given = handle.getValueState("given", "n long")

    def _next(self) -> int:
        known = self._given.get()
        return known[0] if known else 0

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = sorted((tuple(r[c] for c in self.names) for r in rows), key=lambda r: r[self.order])
        held = [tuple(r) for r in self._rows.get()]
        if not held:
            self._handle.registerTimer(self.closes_ms)
        held += new
        full = len(held) // self.size * self.size
        if not full:
            self._rows.appendList(new)
            return
        n, named = self._next(), Row("shard", "group_no", *self.names)
        for i in range(full):
            yield named(*key, n + i // self.size, *held[i])
        self._given.update((n + full // self.size,))
        if held[full:]:
            self._rows.put(held[full:])
        else:
            self._rows.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, named = self._next(), Row("shard", "group_no", *self.names)
        rest = [tuple(r) for r in self._rows.get()]
        for row in rest:
            yield named(*key, n, *row)
        if rest:
            self._rows.clear()
            self._given.update((n + 1,))

    def close(self) -> None:
        pass


def full_groups(
    df: DataFrame, shard: Column, columns: Sequence[str], order: str, closes_ms: int, size: int = 10
) -> DataFrame:
    """`shard`, `group_no` and the columns of every row, as a buffering sink writes them: the rows of a group
    leave together, and a group has `size` rows unless the watermark has passed `closes_ms`."""
    keyed = df.withColumn("shard", shard)
    schema = T.StructType([
        keyed.schema["shard"], T.StructField("group_no", T.LongType()), *[keyed.schema[c] for c in columns]])
    groups = FullGroups(columns, _ddl(keyed, columns), order, size, closes_ms)
    return keyed.groupBy("shard").transformWithState(groups, schema, "append", "EventTime")
