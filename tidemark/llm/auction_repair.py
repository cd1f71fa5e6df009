"""Repair of damaged conversations: the cheapest edits that make roles alternate, by auction.

The turns of a conversation and the states of the wanted role sequence `(s?(ua)+)?` span a lattice: a
node is a number of turns read and a state, an arc an edit with a whole cost.

    D  delete the turn                      3   (the only edit of a blank or repeated turn)
    I  insert an empty turn                 2   (user or assistant, whichever the state wants)
    K  keep the turn                        0   (its role's initial is the wanted one)
    R  give the turn the wanted role        2

A truncated turn that stays costs 1 more. The auction keeps a path from the origin and a price for every
node, never above the cost of an arc plus the price of its end. The path's last node is extended along an
arc that holds this with equality; if there is none, its price rises to the least such sum and the path
contracts. When the path reaches the goal, every cheapest path runs along arcs of equality, so the edits
that come first in ASCII order are read off those arcs.

Long conversations are a tree: up to FAN turns or parts form a lattice whose arcs are the cheapest edits
between two states. A part ends with the edit of its last turn, so the edits of two ways through a part
are never one the beginning of the other, and comparing part by part is comparing as a whole. A
conversation with more turns than ROWS_PER_SLICE is cut into slices along its order (`operators.slices`);
each slice gives its sixteen costs and the rank of each way, one task chooses the states at the borders from
these few numbers, and every slice then writes its own edits. So no task holds a whole large conversation.

Nulls: a null role or text is one space, a null turn comes first and is part of no gap, a null conversation
id is a conversation like any other. Turns are read by (turn, role, text); equal rows are repetitions. Very
long texts and extra columns change nothing. A conversation whose rows were all dropped has zeros and no
edits. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.spread import written
from tidemark.operators.slices import find_cuts, slice_rows

# Turns of one conversation that one task edits; a longer one is cut.
ROWS_PER_SLICE = 1 << 14
# Turns or parts that form one lattice.
FAN = 16
# States: nothing written yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FOLLOWING = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
# The characters between words, and those that end a sentence.
SPACE, ENDS = " \t\n\v\f\r", ".!?"
LEGAL = {"su", "ua", "au"}

Arc = tuple[str, int, int]  # edits, cost, end
Way = tuple[int, str]  # cost, edits
Table = tuple[tuple["Way | None", ...], ...]  # by the state before and after


# The auction.


def to_goal(arcs: Sequence[Sequence[Arc]], goal: int) -> list[list[Arc]]:
    """The arcs on some way to the goal; from other nodes prices would rise without end."""
    into: list[list[int]] = [[] for _ in arcs]
    for i, out in enumerate(arcs):
        for _, _, j in out:
            into[j].append(i)
    reach, todo = {goal}, [goal]
    while todo:
        for i in into[todo.pop()]:
            if i not in reach:
                reach.add(i)
                todo.append(i)
    return [[a for a in out if a[2] in reach] if i in reach else [] for i, out in enumerate(arcs)]


def auction(arcs: Sequence[Sequence[Arc]], prices: list[int], origin: int, goal: int) -> None:
    """Raise the prices until the path from the origin reaches the goal.

    Before and after, `prices[i] <= cost + prices[j]` for every arc, with equality along the path. Prices
    may stay for the next origin. Cycles of arcs cost more than nothing, so a path never meets itself.
    """
    path = [origin]
    while (i := path[-1]) != goal:
        least, end = min((cost + prices[j], j) for _, cost, j in arcs[i])
        if prices[i] < least:
            prices[i] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(end)


def first_edits(arcs: Sequence[Sequence[Arc]], prices: list[int], origin: int, goal: int) -> str:
    """The edits that come first among those along arcs of equality from the origin to the goal."""
    leads = {goal: True}

    def tight(i: int) -> list[Arc]:
        return [a for a in arcs[i] if prices[i] == a[1] + prices[a[2]]]

    def arrives(i: int) -> bool:
        if i not in leads:
            leads[i] = any([arrives(j) for _, _, j in tight(i)])
        return leads[i]

    edits, i = [], origin
    while i != goal:
        edit, _, i = min(a for a in tight(i) if arrives(a[2]))
        edits.append(edit)
    return "".join(edits)


def bounds(arcs: Sequence[Sequence[Arc]], layers: int) -> list[int]:
    """First prices: for every node the least costs that any layer after it takes, added up."""
    prices = [0] * len(arcs)
    for layer in range(layers - 1, -1, -1):
        ends = 4 * (layer + 1)
        least = min((c + prices[j] for q in STATES for _, c, j in arcs[4 * layer + q] if j >= ends), default=0)
        for q in STATES:
            prices[4 * layer + q] = least
    return prices


def ways(arcs: Sequence[Sequence[Arc]], layers: int) -> Table:
    """The cheapest way from every state before the first layer to every state after the last."""
    table: list[list[Way | None]] = [[None] * 4 for _ in STATES]
    for after in STATES:
        goal = 4 * layers + after
        leading = to_goal(arcs, goal)
        prices = bounds(leading, layers)
        for before in STATES:
            if leading[before]:
                auction(leading, prices, before, goal)
                table[before][after] = (prices[before] - prices[goal],
                                        first_edits(leading, prices, before, goal))
    return tuple(map(tuple, table))


# The lattice. Turns are letters: the initial s, u, a or o for any other, in upper case if truncated,
# and x for one that must go.


def arcs_of(turn: str, state: int, at: int) -> list[Arc]:
    """The edits of one turn in a state; `at` is the first node of the layer after it."""
    found = [("D", DELETE, at + state)]
    if turn != "x":
        more, after = TRUNCATED * turn.isupper(), FOLLOWING[state]
        found.append(("R", REROLE + more, at + after))
        if turn.lower() == NAMES[after][0]:
            found.append(("K", more, at + after))
        elif state == START and turn.lower() == "s":
            found.append(("K", more, at + SYSTEM))
    return found


def lattice(turns: str) -> list[list[Arc]]:
    arcs: list[list[Arc]] = []
    for n, turn in enumerate(turns):
        for q in STATES:
            arcs.append([("I", INSERT, 4 * n + FOLLOWING[q]), *arcs_of(turn, q, 4 * (n + 1))])
    return [*arcs, *([] for _ in STATES)]


def of_parts(parts: Sequence[Table]) -> list[list[Arc]]:
    arcs: list[list[Arc]] = []
    for n, part in enumerate(parts):
        for q in STATES:
            arcs.append([(way[1], way[0], 4 * (n + 1) + after)
                         for after, way in enumerate(part[q]) if way is not None])
    return [*arcs, *([] for _ in STATES)]


def joined(parts: Sequence[Table]) -> Table:
    """One table for neighbouring parts."""
    while len(parts) > 1:
        parts = [ways(of_parts(parts[i:i + FAN]), len(parts[i:i + FAN])) for i in range(0, len(parts), FAN)]
    return parts[0]


@lru_cache(maxsize=1 << 14)
def short_table(turns: str) -> Table:
    return ways(lattice(turns), len(turns))


def table_of(turns: str) -> Table:
    return joined([short_table(turns[i:i + FAN]) for i in range(0, len(turns), FAN)])


@lru_cache(maxsize=1 << 14)
def short_edits(turns: str) -> Way:
    """The edits of a whole conversation of up to FAN turns: turns that are due may follow its last."""
    n = len(turns)
    arcs, end = lattice(turns), 4 * (n + 1)
    for q in STATES:
        arcs[4 * n + q] = [("I", INSERT, 4 * n + FOLLOWING[q])]
        if q in (START, ASSISTANT):
            arcs[4 * n + q].append(("", 0, end))
    arcs.append([])
    arcs = to_goal(arcs, end)
    prices = bounds(arcs, n)
    auction(arcs, prices, START, end)
    return prices[START] - prices[end], first_edits(arcs, prices, START, end)


# What must follow the last turn in a state.
DUE = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def closed(table: Table) -> tuple[int, str, int]:
    """Cost, edits but those due at the end, and last state of the best way from START on."""
    found = [(way[0] + INSERT * len(DUE[q]), way[1], q) for q, way in enumerate(table[START]) if way]
    return min(found)


def best_edits(turns: str) -> Way:
    if len(turns) <= FAN:
        return short_edits(turns)
    cost, edits, state = closed(table_of(turns))
    return cost, edits + DUE[state]


# Turns of one conversation or slice.


class Faults:
    """What is wrong with neighbouring turns, given as (turn, role, text, copies, said before)."""

    def __init__(self, rows: Sequence[tuple]):
        self.rows = rows
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        seen: set[tuple[str, str]] = set()
        letters: list[str] = []
        initials: list[str] = []
        for _, role, text, copies, said in rows:
            words, what = text.strip(SPACE), (role, text)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            repeated = copies if said or what in seen else copies - 1
            seen.add(what)
            letter = "x"
            if not words:
                self.blank += copies
                letters.append("x" * copies)
            else:
                if repeated < copies:
                    cut = words[-1] not in ENDS
                    self.truncated += cut
                    letter = initial.upper() if cut else initial
                    letters.append(letter)
                self.duplicate += repeated
                letters.append("x" * repeated)
            self.illegal += copies - 1
            if initials:
                self.illegal += initials[-1] + role[:1] not in LEGAL
            initials.append(role[:1])
        self.first, self.last = (initials[0], initials[-1]) if initials else (None, None)
        turns = [r[0] for r in rows if r[0] is not None]
        self.least, self.most = (min(turns), max(turns)) if turns else (None, None)
        self.turns = len(set(turns))
        self.letters = "".join(letters)

    def repaired(self, edits: str, state: int = START) -> list[dict[str, str]]:
        """The turns that the edits leave or add."""
        made, rows = [], ((r[1], r[2]) for r in self.rows for _ in range(r[3]))
        for edit in edits:
            role, text = ("", "") if edit == "I" else next(rows)
            if edit == "D":
                continue
            if edit == "K" and state == START and role[:1] == "s":
                state = SYSTEM
            else:
                state = FOLLOWING[state]
                role = role if edit == "K" else NAMES[state]
            made.append({"role": role, "text": text})
        return made


TURN = "struct<turn:long,role:string,text:string,copies:int,said:boolean>"
REPAIRED = "array<struct<role:string,text:string>>"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_SLICE = ("slice int, first string, last string, least long, most long, turns long, blank long, "
          "duplicate long, truncated long, illegal long")
_PAIRS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _rows_of(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """The turns of each row, without those that were dropped."""
    lists = batch["rows"]
    ends, flat = lists.offsets.to_pylist(), lists.values
    fields = [flat.field(f).to_pylist() for f in ("turn", "role", "text", "copies", "said")]
    every = list(zip(*fields, strict=True))
    for low, high in zip(ends, ends[1:]):
        yield [r for r in every[low:high] if r[3] > 0]


def _map(df: DataFrame, work: Callable[[pa.RecordBatch, list[Faults]], dict[str, list]], schema: str) -> DataFrame:
    """`work` gives further columns for a batch of slices; the id and what is wrong come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [Faults(rows) for rows in _rows_of(batch)]
            made = {"conv_id": batch["conv_id"], "slice": batch["slice"]}
            for name in ("first", "last"):
                made[name] = pa.array([getattr(f, name) for f in found], pa.string())
            for name in ("least", "most", "turns", *_COUNTS):
                made[name] = pa.array([getattr(f, name) for f in found], pa.int64())
            for name, values in work(batch, found).items():
                made[name] = values if isinstance(values, pa.Array) else pa.array(values)
            yield pa.RecordBatch.from_pydict(made)

    kind = dict(df.dtypes)["conv_id"]
    return df.mapInArrow(run, f"conv_id {kind}, {_SLICE}, {schema}")


def _edited(batch: pa.RecordBatch, found: list[Faults]) -> dict[str, list]:
    best = [best_edits(f.letters) for f in found]
    return {
        "cost": pa.array([b[0] for b in best], pa.int64()), "audit": pa.array([b[1] for b in best], pa.string()),
        "repaired": pa.array([f.repaired(b[1]) for f, b in zip(found, best, strict=True)], _PAIRS)}


def _tables(batch: pa.RecordBatch, found: list[Faults]) -> dict[str, list]:
    """Costs of the sixteen ways through each slice, -1 where there is none, and the rank of each way's
    edits among those from the same state."""
    costs, ranks = [], []
    for f in found:
        table = table_of(f.letters) if f.letters else _NOTHING
        order = [sorted(way[1] for way in row if way) for row in table]
        costs.append([way[0] if way else -1 for row in table for way in row])
        ranks.append([order[q].index(way[1]) if way else -1 for q, row in enumerate(table) for way in row])
    return {"costs": pa.array(costs, pa.list_(pa.int64())), "ranks": pa.array(ranks, pa.list_(pa.int32()))}


_NOTHING: Table = tuple(tuple((0, "") if p == q else None for p in STATES) for q in STATES)


def _edited_between(batch: pa.RecordBatch, found: list[Faults]) -> dict[str, list]:
    costs, audits, repaired = [], [], []
    for f, q, p, due in zip(found, *(batch[c].to_pylist() for c in ("enters", "leaves", "due")), strict=True):
        cost, edits = (table_of(f.letters) if f.letters else _NOTHING)[q][p]
        costs.append(cost + INSERT * len(due))
        audits.append(edits + due)
        repaired.append(f.repaired(edits + due, q))
    return {"cost": pa.array(costs, pa.int64()), "audit": pa.array(audits, pa.string()),
            "repaired": pa.array(repaired, _PAIRS)}


def _borders(group: pa.Table) -> pa.Table:
    """The states at the borders of one conversation's slices, from the tables of all its slices."""
    group = group.sort_by("slice")
    tables = [
        tuple(tuple((c, chr(r)) if c >= 0 else None for c, r in zip(costs[4 * q:4 * q + 4], ranks[4 * q:4 * q + 4]))
              for q in STATES)
        for costs, ranks in zip(group["costs"].to_pylist(), group["ranks"].to_pylist(), strict=True)]
    _, chosen, last = closed(joined(tables))
    enters, leaves, state = [], [], START
    for table, rank in zip(tables, chosen, strict=True):
        enters.append(state)
        state = next(p for p, way in enumerate(table[state]) if way and way[1] == rank)
        leaves.append(state)
    due = [""] * (len(tables) - 1) + [DUE[last]]
    return pa.table({
        "conv_id": group["conv_id"], "slice": group["slice"], "enters": pa.array(enters, pa.int32()),
        "leaves": pa.array(leaves, pa.int32()), "due": due})


# The operator on tables.


def damaged(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, `role`, `text`, `copies` of the rows after the damage that a hash of (conv_id, turn)
    decides: dropped (0 copies), emptied, without sentence ends, repeated (2 copies), or said by the user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space))
    kind, role, text = F.col("_kind"), F.coalesce("role", space), F.coalesce("text", space)
    return conversations.select("conv_id", "turn", "role", "text").withColumn("_kind", F.crc32(name) % 20).select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _packed(rows: DataFrame, said: Column, slice_: Column) -> DataFrame:
    turn = F.struct("turn", "role", "text", F.col("copies").cast("int").alias("copies"), said.alias("said"))
    return (
        rows.select("conv_id", slice_.alias("slice"), turn.alias("row")).groupBy("conv_id", "slice")
        .agg(F.sort_array(F.collect_list("row")).cast(f"array<{TURN}>").alias("rows")))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def repair(turns: DataFrame, rows_per_slice: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The edits of every conversation of `turns` (`conv_id`, `turn`, `role`, `text`, `copies`).

    Returns the conversations that one task edits, one row each, and the slices of longer ones, None if
    there are none. Both have `conv_id`, `slice` (0, or from 1 on), the counts of faults inside, first
    and last initial, least, most and number of turns, `cost`, `audit` and the `repaired` turns in order.
    """
    edited = f"cost long, audit string, repaired {REPAIRED}"
    order = ["turn", "role", "text"]
    cuts = find_cuts(turns, ["conv_id"], order, rows_per_slice or ROWS_PER_SLICE)
    if cuts.table is None:
        return _map(_packed(turns, F.lit(False), F.lit(0)), _edited, edited), None
    long = cuts.table.select(F.col("conv_id").alias("_long"))
    rest = turns.join(long, _same("conv_id", "_long"), "left_anti")
    whole = _map(_packed(rest, F.lit(False), F.lit(0)), _edited, edited)
    # Equal rows become one with their number, however many there are.
    own = (
        turns.join(long, _same("conv_id", "_long"), "left_semi")
        .groupBy("conv_id", *order).agg(F.sum("copies").cast("int").alias("copies")))
    said = F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                              F.length("role"), "role", "text"), 256)
    rows = slice_rows(own, ["conv_id"], order, cuts=cuts).rows.withColumn("_said", said)
    first = (
        rows.filter("copies > 0").groupBy("_said").agg(F.min("_slice").alias("_first"), F.max("_slice").alias("_last"))
        .filter("_first < _last").select("_said", "_first"))
    rows = rows.join(first, "_said", "left")
    earlier = F.coalesce(F.col("_first") < F.col("_slice"), F.lit(False))
    slices = written(_packed(rows, earlier, F.col("_slice")), "conversation-slices")
    kind = dict(turns.dtypes)["conv_id"]
    tables = _map(slices, _tables, "costs array<long>, ranks array<int>").select("conv_id", "slice", "costs", "ranks")
    borders = tables.groupBy("conv_id").applyInArrow(
        _borders, f"conv_id {kind}, slice int, enters int, leaves int, due string")
    borders = borders.withColumnsRenamed({"conv_id": "_conv", "slice": "_at"})
    placed = slices.join(borders, _same("conv_id", "_conv") & (F.col("slice") == F.col("_at")))
    return whole, _map(placed.drop("_conv", "_at"), _edited_between, edited)


def _gaps() -> Column:
    gaps = F.col("most").cast("decimal(38,0)") - F.col("least") + 1 - F.col("turns")
    gaps = F.when(gaps.isNull(), 0).otherwise(F.least(gaps, F.lit((1 << 63) - 1)))
    return gaps.cast("long").alias("gaps")


def _lines() -> Column:
    return F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")


def _hash_of_slices(slices: DataFrame) -> DataFrame:
    """SHA-256 of each long conversation's lines. The hash reads them in order, so one task does it for a
    conversation, with one slice of it in memory."""
    kind = dict(slices.dtypes)["conv_id"]
    lines = slices.select("conv_id", "slice", (F.size("repaired") > 0).alias("any"), _lines().alias("lines"))
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, own, empty, begun = hashlib.sha256(), None, True, False
        for batch in batches:
            for conv, some, text in zip(batch["conv_id"], batch["any"], batch["lines"], strict=True):
                if begun and conv.as_py() != own:
                    yield pa.RecordBatch.from_pydict({
                        "conv_id": pa.array([own], batch["conv_id"].type), "repaired_sha256": [state.hexdigest()]})
                    state, empty = hashlib.sha256(), True
                own, begun, typed = conv.as_py(), True, batch["conv_id"].type
                if some.as_py():
                    state.update(b"" if empty else b"\n")
                    state.update(text.as_py().encode())
                    empty = False
        if begun:
            yield pa.RecordBatch.from_pydict({
                "conv_id": pa.array([own], typed), "repaired_sha256": [state.hexdigest()]})

    return ordered.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair_report(conversations: DataFrame, rows_per_slice: int | None = None) -> DataFrame:
    """One row for each conversation id of the table: what is wrong after the damage, the cost and the
    initials of the edits, and the SHA-256 of the repaired turns."""
    whole, slices = repair(damaged(conversations), rows_per_slice)
    columns = ["conv_id", "gaps", *_COUNTS, "cost", "audit", "repaired_sha256"]
    report = whole.select(
        "conv_id", _gaps(), *_COUNTS, "cost", "audit", F.sha2(_lines(), 256).alias("repaired_sha256"))
    if slices is None:
        return report.select(*columns)
    slices = written(slices, "conversation-edits")
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    last, most = F.last("last", True).over(before), F.last("most", True).over(before)
    # Neighbours across a border, and a turn number that two slices share.
    pair = F.concat(last, "first")
    across = F.when(pair.isNull() | pair.isin(*LEGAL), 0).otherwise(1)
    small = slices.drop("repaired").withColumns({
        "illegal": F.col("illegal") + across,
        "turns": F.col("turns") - F.coalesce((most == F.col("least")).cast("long"), F.lit(0))})
    audit = F.sort_array(F.collect_list(F.struct("slice", "audit")))
    summed = small.groupBy("conv_id").agg(
        F.min("least").alias("least"), F.max("most").alias("most"), F.sum("turns").alias("turns"),
        *[F.sum(c).alias(c) for c in (*_COUNTS, "cost")],
        F.array_join(F.transform(audit, lambda a: a["audit"]), "").alias("audit"))
    hashes = _hash_of_slices(slices).withColumnRenamed("conv_id", "_conv")
    long = summed.join(hashes, _same("conv_id", "_conv")).select(
        "conv_id", _gaps(), *_COUNTS, "cost", "audit", "repaired_sha256")
    return report.select(*columns).unionByName(long.select(*columns))


# The same in SQL: an edit table filled row by row, with the best (cost, edits) of each state.
_LEAST = "list_sort([{}], 'ASC', 'NULLS LAST')[1]"


def _sql() -> str:
    def way(state: int, cost: str, edits: str, line: str | None = None) -> str:
        lines = f"s{state}.lines" if line is None else f"list_append(s{state}.lines, {line})"
        return f"{{'cost': s{state}.cost + {cost}, 'edits': s{state}.edits || '{edits}', 'lines': {lines}}}"

    def inserted(state: int, by: list[tuple[int, int]]) -> str:
        """The state reached from others by as many insertions."""
        found = [f"s{state}"]
        for origin, n in by:
            new = ["'user:'", "'assistant:'"] if n == 2 else ["'assistant:'" if state == ASSISTANT else "'user:'"]
            lines = f"list_concat(s{origin}.lines, [{', '.join(new)}])"
            found.append(f"{{'cost': s{origin}.cost + {2 * n}, 'edits': s{origin}.edits || '{'I' * n}', 'lines': {lines}}}")
        return f"{_LEAST.format(', '.join(found))} AS s{state}"

    def best(*found: str) -> str:
        return _LEAST.format(", ".join(found))

    def when(test: str, value: str) -> str:
        return f"CASE WHEN {test} THEN {value} END"

    kept, role_of = "r.role || ':' || r.body", "NOT r.gone"
    given = {USER: "'user:' || r.body", ASSISTANT: "'assistant:' || r.body"}
    step = ", ".join([
        f"{way(START, '3', 'D')} AS s0",
        f"{best(way(SYSTEM, '3', 'D'), when(f's0.cost IS NOT NULL AND {role_of} AND r.initial = {chr(39)}s{chr(39)}', way(START, 'r.cut', 'K', kept)))} AS s1",
        f"{best(way(USER, '3', 'D'), *[x for q in (START, SYSTEM, ASSISTANT) for x in (when(f'{role_of} AND r.initial = {chr(39)}u{chr(39)}', way(q, 'r.cut', 'K', kept)), when(role_of, way(q, '2 + r.cut', 'R', given[USER])))])} AS s2",
        f"{best(way(ASSISTANT, '3', 'D'), when(f'{role_of} AND r.initial = {chr(39)}a{chr(39)}', way(USER, 'r.cut', 'K', kept)), when(role_of, way(USER, '2 + r.cut', 'R', given[ASSISTANT])))} AS s3"])
    nothing = "{'cost': 1000000000, 'edits': '', 'lines': []::VARCHAR[]}"
    relaxed = ", ".join([
        "s0", "s1", inserted(USER, [(START, 1), (SYSTEM, 1), (ASSISTANT, 1)]),
        inserted(ASSISTANT, [(USER, 1), (START, 2), (SYSTEM, 2)])])
    space = r"[\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS t),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hashed AS (
  SELECT n.*, xor(4294967295, list_reduce(list_prepend(4294967295,
      list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i, 1))::BIGINT)),
    lambda c, b: xor(c >> 8, crc.t[1 + (xor(c, b) & 255)]))) % 20 AS kind
  FROM named n, crc),
rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body
  FROM hashed, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) AS n,
    regexp_replace(body, '{space}+$', '') AS words, substr(role, 1, 1) AS initial FROM rows),
copies AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, body ORDER BY n) AS copy FROM placed),
judged AS (
  SELECT *, words = '' AS blank, words <> '' AND copy > 1 AS duplicate,
    words <> '' AND copy = 1 AND right(words, 1) NOT IN ('.', '!', '?') AS truncated,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM copies),
turns AS (
  SELECT conv_id, n, role, body, initial, blank OR duplicate AS gone, truncated::INT AS cut FROM judged),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    sum(blank::INT)::BIGINT AS blank, sum(duplicate::INT)::BIGINT AS duplicate,
    sum(truncated::INT)::BIGINT AS truncated, coalesce(sum(illegal::INT), 0)::BIGINT AS illegal,
    count(*) AS n FROM judged GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
steps AS (
  SELECT conv_id, 0::BIGINT AS n, {{'cost': 0, 'edits': '', 'lines': []::VARCHAR[]}} AS s0, {nothing} AS s1,
    {nothing} AS s2, {nothing} AS s3 FROM ids
  UNION ALL
  SELECT e.conv_id, r.n, {step}
  FROM (SELECT conv_id, n, {relaxed} FROM steps) e
  JOIN turns r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.n = e.n + 1),
ended AS (
  SELECT s.conv_id, {best('s0', 's3')} AS best
  FROM (SELECT conv_id, n, {relaxed} FROM steps) s LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id
  WHERE s.n = coalesce(c.n, 0))
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost, best.edits AS audit,
  sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""


CONVERSATIONS_SQL = _sql()
