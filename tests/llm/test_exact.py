"""Conversation repair, byte-level BPE and centroid clustering against plain forms, and on awkward rows."""

import hashlib
import heapq
import itertools
import random
import zlib

import duckdb
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import CLASHES, awkward_rows
from tidemark.llm import auction_repair, bisector_clusters, word_table
from tidemark.llm.auction_repair import best_edits, closed, repair_report, table_of
from tidemark.llm.bisector_clusters import Tournament, clusters

TURNS = "conv_id long, turn long, role string, text string"


# Conversations.


def cheapest(turns):
    """All edits by a search over (turns read, state): least cost, then least edits."""
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    todo, done = [(0, "", 0, "")], set()
    while todo:
        cost, edits, n, state = heapq.heappop(todo)
        if n == len(turns) and state in ("", "a"):
            return cost, edits
        if (n, state) in done:
            continue
        done.add((n, state))
        new = follows[state]
        heapq.heappush(todo, (cost + 2, edits + "I", n, new))
        if n < len(turns):
            t = turns[n]
            heapq.heappush(todo, (cost + 3, edits + "D", n + 1, state))
            if t != "x":
                more = t.isupper()
                heapq.heappush(todo, (cost + 2 + more, edits + "R", n + 1, new))
                if t.lower() == new:
                    heapq.heappush(todo, (cost + more, edits + "K", n + 1, new))
                if t.lower() == "s" and state == "":
                    heapq.heappush(todo, (cost + more, edits + "K", n + 1, "s"))


def brute_report(rows):
    """The report of some rows, one conversation after the other."""
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        own += [(turn is not None, turn or 0, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    report = []
    for conv, own in convs.items():
        own.sort()
        seen, letters = set(), []
        for _, _, role, text in own:
            words = text.strip(" \t\n\v\f\r")
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            fault = "b" if not words else "d" if (role, text) in seen else "" if words[-1] in ".!?" else "t"
            letters.append(("x" if fault in ("b", "d") and fault else initial.upper() if fault else initial, fault))
            seen.add((role, text))
        cost, edits = cheapest([x for x, _ in letters])
        made, rest, state = [], iter(own), ""
        for e in edits:
            _, _, role, text = (0, 0, "", "") if e == "I" else next(rest)
            if e == "D":
                continue
            if e == "K":
                state = role[:1]
            else:
                state = {"u": "a"}.get(state, "u")
                role = {"u": "user", "a": "assistant"}[state]
            made.append(f"{role}:{text}")
        turns = [t for there, t, _, _ in own if there]
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(own)]
        faults = [f for _, f in letters]
        report.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"),
            faults.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, edits,
            hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(report, key=str)


def conversation_rows(seed, n):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["Yes.", "No", "", None, "Why?", " \n", "ünd so", "x" * 3000 + "!", "A b. ", "A b.  "]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(n) for t in range(rng.randrange(1, 9))]
    rows += [(None, None, None, None), (None, 3, "user", "Hm."), (7, None, "user", "Yes."), (8, 2**63 - 1, "user", "a"),
             (8, -(2**63), "user", "a")]
    # One long conversation: equal rows by the dozen, and one text in every turn.
    rows += [(1000, t // 3, rng.choice(["user", "assistant"]), "Again.") for t in range(60)]
    rows += [(1000, 7, "user", "Same row.")] * 40
    rows += [(1000, t, rng.choice(roles), f"{rng.randrange(40)}{rng.choice('.a')}") for t in range(150)]
    return rows + rows[:5]


def test_edits_of_every_short_conversation():
    for n in range(5):
        for turns in itertools.product("suaoUx", repeat=n):
            assert best_edits("".join(turns)) == cheapest(turns)


def test_edits_of_long_conversations():
    rng = random.Random(3)
    for _ in range(25):
        turns = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(17, 700)))
        assert best_edits(turns) == cheapest(turns)
        cost, edits, state = closed(table_of(turns))
        assert (cost, edits + auction_repair.DUE[state]) == cheapest(turns)


def test_prices_stay_below_arcs_and_equal_on_the_way():
    arcs = auction_repair.to_goal(auction_repair.lattice("suxUaaou"), 4 * 8 + auction_repair.ASSISTANT)
    prices = auction_repair.bounds(arcs, 8)
    auction_repair.auction(arcs, prices, 0, 4 * 8 + auction_repair.ASSISTANT)
    assert all(prices[i] <= c + prices[j] for i, out in enumerate(arcs) for _, c, j in out)
    assert prices[0] - prices[4 * 8 + auction_repair.ASSISTANT] == table_of("suxUaaou")[0][3][0]


@pytest.mark.parametrize("size", [None, 6])
def test_report_against_a_plain_form(spark, size):
    from pyspark.sql import functions as F

    rows = [r for r in conversation_rows(1, 60) if r[1] is None or abs(r[1]) < 2**40]
    df = spark.createDataFrame(rows, TURNS).repartition(3).withColumns({c: F.lit("clash") for c in CLASHES})
    made = repair_report(df, size)
    assert made.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                            "repaired_sha256"]
    assert sorted((tuple(r) for r in made.collect()), key=str) == brute_report(rows)


def test_report_against_sql_and_on_extremes(spark):
    rows = conversation_rows(2, 40)
    df = spark.createDataFrame(rows, TURNS)
    assert {r["conv_id"]: r["gaps"] for r in repair_report(df).collect()}[8] == 2**63 - 1
    some = [r for r in rows if r[0] != 8]
    conversations = spark.createDataFrame(some, TURNS).toPandas().astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", conversations)
    assert sorted(con.execute(auction_repair.CONVERSATIONS_SQL).fetchall(), key=str) == brute_report(some)


def test_conversations_without_rows(spark):
    assert repair_report(spark.createDataFrame([], TURNS)).count() == 0
    dropped = [c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    rows = spark.createDataFrame([(c, 0, "user", "Hi.") for c in dropped], TURNS)
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, repair_report(rows).collect())) == [(c, 0, 0, 0, 0, 0, 0, "", empty) for c in dropped]


# Byte-level BPE.


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(word_table.VOCABULARY)
    found.no_truncation()
    found.no_padding()
    return found


def strange_texts(seed, n):
    rng = random.Random(seed)
    bits = [" ", "  ", "\n", " \n", "\t", "the", "The", "ing", "'s", "'ll", "'", "1", "23", "é", "日本", "՘", "࢏",
            "\U00010940", "👩‍👩", " ", " ", "\x1c", "\x85", "<|endoftext|>", "<|endof", "!?", "_", "a" * 90, " " * 30,
            "\u0000", "ß", "ẞ", "́"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 30))) for _ in range(n)]


def test_words_are_those_of_the_library(library):
    vocabulary = word_table.vocabulary(word_table.VOCABULARY)
    texts = strange_texts(1, 3000)
    block = word_table.Block(word_table.Splitter(word_table.VOCABULARY), pa.chunked_array([texts]))
    for text, numbers in zip(texts, block.numbers(), strict=True):
        ids = [i for w in numbers for i in vocabulary.encode(block.order[w])]
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_words_and_packed_numbers(library):
    import numpy as np

    rng = random.Random(2)
    vocabulary = word_table.vocabulary(word_table.VOCABULARY)
    for size in (39, 40, 41, 300, 20_000):
        for letters in ("a", "ab", "etaoin"):
            word = "".join(rng.choice(letters) for _ in range(size))
            assert vocabulary.encode(word) == library.encode(word, add_special_tokens=False).ids
    for numbers in ([], [0], [1, 2**32 - 1, 70_000] * 500):
        assert word_table.unpacked(word_table.packed(np.array(numbers, np.uint32))).tolist() == numbers


@pytest.mark.parametrize("size", [word_table.BLOCK_BYTES, 200])
def test_round_trip_against_the_library(spark, library, awkward, monkeypatch, size):
    monkeypatch.setattr(word_table, "BLOCK_BYTES", size)
    rows = [(r[0], r[1]) for r in awkward_rows()] + [(100 + i, t) for i, t in enumerate(strange_texts(3, 60))]
    df = awkward.select("doc_id", "text", "score", "part").unionByName(
        spark.createDataFrame(rows[len(awkward_rows()):], "doc_id long, text string"), allowMissingColumns=True)
    wanted = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert back == (text or "")
        wanted.append((doc, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(),
                       hashlib.sha256(back.encode()).hexdigest()))
    made = word_table.round_trip(df)
    assert made.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, made.collect()), key=str) == sorted(wanted, key=str)
    ids = word_table.encode_documents(df, keep=("doc_id", "score"))
    texts = word_table.decode_documents(ids, keep=("doc_id", "score"))
    assert texts.columns == ["doc_id", "score", "text"]
    assert sorted(((r[0], r[2]) for r in texts.collect()), key=str) == sorted(((d, t or "") for d, t in rows), key=str)


def test_ids_that_are_no_whole_text(spark, library, no_docs):
    rows = [(1, [447, 50256, 247]), (2, None), (3, []), (4, [464, 999_999, None, 262, -5])]
    made = dict(map(tuple, word_table.decode_documents(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()))
    assert made[1] == library.decode([447, 50256, 247], skip_special_tokens=False)
    assert made[2] == made[3] == "" and made[4] == library.decode([464, 262], skip_special_tokens=False)
    assert word_table.round_trip(no_docs).count() == 0


# Clusters.


def brute_clusters(rows, k, rounds, size):
    from math import floor, isfinite

    kept = [(i, [floor(256 * _fraction(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(own[n]) for x in zip(*own[n])] if n in own else c for n, c in enumerate(centroids)]
    ends = [(i, *nearest(v)[::-1]) for i, v in kept]
    top, total = 2**63 - 1, sum(d for _, _, d in ends)
    inertia = {c: sum(d for _, e, d in ends if e == c) for _, c, _ in ends}
    return sorted(((i, c, min(d, top), inertia[c], total, hashlib.sha256(
        ",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in ends), key=str)


def _fraction(x):
    from fractions import Fraction

    return Fraction(x)


def vectors(seed, n, size, spread=1.0):
    rng = random.Random(seed)
    own = [[rng.gauss(0, 0.2) * spread for _ in range(size)] for _ in range(4)]
    rows = [(i, [x + rng.choice((0, 0.25, -0.25)) for x in rng.choice(own)]) for i in range(n)]
    return rows + rows[:7] + [(None, own[0]), (500, None), (501, []), (502, own[0][:-1]), (503, [None] + own[0][1:]),
                              (504, [float("nan")] + own[0][1:]), (505, [float("-inf")] + own[0][1:])]


@pytest.mark.parametrize("k,n,spread", [(6, 80, 1.0), (5, 3, 1.0), (1, 20, 1.0), (4, 40, 1e12)])
def test_clusters_against_a_plain_form(spark, k, n, spread):
    from pyspark.sql import functions as F

    rows = vectors(k, n, 8, spread)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).withColumns(
        {c: F.lit("clash") for c in [*CLASHES, "cluster", "distance"]})
    made = clusters(df, k, 3, 8)
    assert made.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    wanted = brute_clusters(rows, k, 3, 8)
    if spread == 1.0:
        assert sorted(map(tuple, made.collect()), key=str) == wanted
    else:  # sums of more than 64 bits end at the largest long, each of its own
        assert sorted((r[0], r[1], r[5]) for r in made.collect() if r[0] is not None) == sorted(
            (r[0], r[1], r[5]) for r in wanted if r[0] is not None)


def test_clusters_of_no_vectors(spark):
    made = clusters(spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>"))
    assert made.count() == 0 and made.columns[:3] == ["vec_id", "cluster", "distance"]


def test_ties_go_to_the_smaller_number_and_limbs_add_up():
    import numpy as np

    winner, far = Tournament([[0, 0], [4, 0], [4, 0], [0, 4]]).nearest(np.array([[2, 0], [4, 1], [2, 2], [0, 3]]))
    assert winner.tolist() == [0, 1, 0, 3] and far.tolist() == [4, 1, 8, 1]
    for value in (0, 5, -5, 2**48, -(2**200) + 1):
        assert sum(part << (48 * n) for n, part in bisector_clusters.limbs(value)) == value


# Pieces under merge-dropout, many texts at once.


@pytest.mark.parametrize("options", [(0.1,), (0.0,), (0.6, None, 5), (0.3, 4, 7), (0.95,)])
def test_blocks_of_texts_give_the_ids_of_each(options):
    from tidemark.llm.merge_dropout import MODEL, Encoder, Pieces

    rng = random.Random(4)
    with open(MODEL, "rb") as file:
        pieces = Pieces(file.read())
    bits = [" ", " ", " ", "  ", "\n", "the ", "Über", "ing", "tion", "▁", ".", "!?", "日本", "x" * 60, "\u0000", "’s "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    texts += ["", " ", "a", "the the the the " * 50, " lead", "trail ", "a\n b"]
    ids, ends = Encoder(pieces, *options).encode_all(pa.array(texts, pa.large_string()))
    single = Encoder(pieces, *options)
    for text, low, high in zip(texts, ends[:-1], ends[1:], strict=True):
        assert ids[low:high].tolist() == single.encode(text).tolist(), repr(text)
    none, at = Encoder(pieces, *options).encode_all(pa.array([], pa.large_string()))
    assert not len(none) and at.tolist() == [0]
