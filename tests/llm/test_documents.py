"""The operators on documents: brute-force results, and defined results for awkward rows."""

import hashlib
import itertools
import random

import duckdb
import pyarrow as pa
import pytest

from tests.llm.conftest import DOCS, awkward_rows, words
from tidemark.llm.block_mixing import Mix, mixed_documents, permuted, targets
from tidemark.llm.line_rules import LINE_RULES_SQL, line_rules
from tidemark.llm.one_permutation import bins_of, edited_prints, fingerprints, likeness, unpacked
from tidemark.llm.passage_chains import (
    _text_keys,
    align,
    chains,
    in_stretches,
    repeated_passages,
    segments_of,
    united,
    without_passages,
)
from tidemark.llm.prefix_join import near_duplicates, one_of_each


def shingle_set(text, size=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_components(rows):
    """Smallest id reachable by links of at least 80 percent, for each row."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted(((doc, len(s), low.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(
        zip(rows, sets, strict=True))), key=str)


def copies(seed, groups=6, size=12):
    """Groups of edited copies, documents that share a passage, and clean ones."""
    rng = random.Random(seed)
    passage, rows = words(rng, 60), []
    for _ in range(groups):
        base = words(rng, rng.randrange(8, 200))
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(4000)}"
            rows.append(" ".join(own))
    rows += [" ".join(words(rng, 60) + passage + words(rng, 60)) for _ in range(20)]
    rows += [" ".join(words(rng, 100)) for _ in range(20)] + ["the same", "The  Same", "other"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_are_those_of_all_pairs(spark):
    rows = copies(3)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(rows)


def test_components_of_awkward_rows(awkward):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    got = sorted(map(tuple, near_duplicates(awkward).collect()), key=str)
    assert got == brute_components(rows)
    kept = one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 5, 7, 8, 9, 10, None, None], key=str)


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert line_rules(no_docs).count() == 0
    assert edited_prints(no_docs).count() == 0
    assert repeated_passages(no_docs).count() == 0
    assert Mix(no_docs).digest().count() == 0
    assert mixed_documents(no_docs).count() == 0


def test_line_rules_equal_their_sql(spark, awkward, tmp_path):
    lines = ["All rights reserved 20%d." % (10 + i) for i in range(3)]
    rng = random.Random(4)
    rows = [(100 + i, "\n".join([*lines, " ".join(words(rng, 12 if i % 2 else 60))]), "en", "s", 1)
            for i in range(30)]
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(rows, DOCS))
    path = str(tmp_path / "documents")
    docs.write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "words_left", "kept"]
    want = con.sql(LINE_RULES_SQL).select(*names).fetchall()
    got = line_rules(spark.read.parquet(path)).select(*names).collect()
    assert sorted(want, key=str) == sorted(map(tuple, got), key=str)
    by_id = {r["doc_id"]: r for r in got}
    # Three frequent lines of four words: most of the short documents, a fifth of the long ones.
    assert by_id[100]["kept"] and by_id[100]["words_left"] == 60
    assert by_id[101]["words_left"] == 12 and by_id[101]["kept"] == (12 >= 0.5 * by_id[101]["n_words"])


def edited(rows):
    """Every row with its edited text, in the order of the operator."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, (r[1] or "").encode()))
    out = []
    for i, (doc, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        out.append((doc, text, text[:len(text) - half] + after[:half], after))
    return out


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_edited_prints(spark, awkward, parts):
    rows = [(r[0], r[1]) for r in awkward_rows()] + [(i + 50, t) for i, t in copies(5)[:60]]
    docs = awkward.select("doc_id", "text").unionByName(
        spark.createDataFrame(rows[len(awkward_rows()):], "doc_id long, text string"))
    got = sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in edited_prints(docs, parts=parts).collect())
    want = sorted((str(d), len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in edited(rows))
    assert got == want


def test_likeness_is_near_jaccard(spark):
    rows = copies(6)
    got = {r["doc_id"]: r for r in edited_prints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    errors = []
    for doc, text, new, after in edited(rows):
        a, b, c = map(shingle_set, (text, new, after))
        errors.append(abs(got[doc]["near_edited"] - len(a & b) / max(1, len(a | b))))
        errors.append(abs(got[doc]["near_next"] - len(a & c) / max(1, len(a | c))))
    assert sum(errors) / len(errors) < 0.03


def test_equal_texts_have_equal_prints_and_empty_ones_none(awkward):
    got = {}
    for r in fingerprints(awkward).collect():
        got.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert got[5] == got[6] and got[1] == got[2] == got[3] == {""} and "" in got[None]
    one = unpacked(next(iter(got[4])))
    assert likeness(one, one) == 1 and likeness(one, one[:0]) == 0 and likeness(one[:0], one[:0]) == 1


def test_bins_keep_the_smallest_hash():
    import numpy as np

    hashes = np.array([5 << 55 | 9, 5 << 55 | 12, 6 << 55 | 3], np.uint64)
    bins = bins_of(hashes)
    assert bins[5] == 9 and bins[6] == 3 and set(bins) <= {9, 3}


def test_chains_skip_gaps_and_keep_order():
    import numpy as np

    q = np.array([0, 5, 10, 40, 45, 90])
    t = np.array([100, 105, 110, 142, 147, 20])
    found = chains(segments_of(q, t))
    assert [(0, 100, 18), (40, 142, 13)] in found and [(90, 20, 8)] in found


def planted(seed=7):
    rng = random.Random(seed)
    passage = words(rng, 70)
    rows, where = [], {}
    for i in range(40):
        own = list(passage)
        for _ in range(i % 4):
            own[rng.randrange(70)] = "changed"
        before, after = words(rng, rng.randrange(0, 120)), words(rng, rng.randrange(0, 120))
        rows.append((i, " ".join(before + own + after)))
        where[i] = len(before)
    rows += [(100 + i, " ".join(words(rng, 200))) for i in range(30)]
    return rows, where


def test_passages_are_found_and_clean_texts_left_alone(spark):
    rows, where = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeated_passages(docs)
    got = found.collect()
    # The text that keeps the passage, and at most a text whose changes fall at its ends, are not listed.
    assert len({r["doc_id"] for r in got}) >= 38 and all(r["doc_id"] < 100 for r in got)
    for r in got:
        assert abs(r["start_word"] - where[r["doc_id"]]) <= 12
        assert r["matched_words"] >= 0.8 * (r["end_word"] - r["start_word"])
    left = {r["doc_id"]: r["text"] for r in without_passages(docs, found).collect()}
    text = dict(rows)
    for r in got:
        w = text[r["doc_id"]].split()
        assert left.get(r["doc_id"], "").split() == w[:r["start_word"]] + w[r["end_word"]:]
    assert all(left[i] == text[i] for i in range(100, 130))


def test_a_chain_too_unlike_as_a_whole_is_cut_into_passages():
    import numpy as np

    # Two runs of 50 words, side by side in one text and 30 words apart in the other.
    t = np.arange(100, dtype=np.uint32)
    q = np.concatenate([t[:50], np.arange(1000, 1030, dtype=np.uint32), t[50:]])
    assert align([(0, 0, 50), (80, 50, 50)], q, t, 0.8) == [(0, 50, 0, 50, 50), (80, 130, 50, 100, 50)]
    # One diagonal: 60 equal words, then 8 equal ones after every 12 others.
    t = np.arange(260, dtype=np.uint32)
    q = t.copy()
    for i in range(60, 260, 20):
        q[i:i + 12] += 5000
    assert align([(0, 0, 260)], q, t, 0.8)[0] == (0, 60, 0, 60, 60)


def test_passages_apart_from_a_long_insertion_are_found(spark):
    rng = random.Random(21)
    rows, cases = [], 20
    for i in range(cases):
        one, two = words(rng, 50, 10**6), words(rng, 50, 10**6)
        rows.append((2 * i, " ".join(words(rng, 80, 10**6) + one + two + words(rng, 80, 10**6))))
        rows.append((2 * i + 1, " ".join(
            words(rng, 80, 10**6) + one + words(rng, 30, 10**6) + two + words(rng, 80, 10**6))))
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for i in range(cases):
        assert sum(r["matched_words"] for r in found if r["doc_id"] // 2 == i) == 100


def test_phrases_of_several_texts_are_no_passage(spark):
    rng = random.Random(22)
    rows, cases = [], 20
    for i in range(cases):
        phrases = [words(rng, 40, 10**6) for _ in range(4)]
        for k, own in enumerate([*phrases, sum(phrases, [])]):
            rows.append((10 * i + k, " ".join(words(rng, 60, 10**6) + own + words(rng, 60, 10**6))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert repeated_passages(docs).count() == 0


def test_spans_unite_only_if_each_counts():
    # Short spans of several texts; two that count and overlap; two whose union is not alike enough.
    assert united([(0, 20, 1, 0, 20), (20, 40, 2, 0, 20), (40, 60, 3, 0, 20)], 50, 0.8, True) == []
    assert united([(0, 60, 1, 5, 60), (50, 110, 2, 0, 60)], 50, 0.8) == [(0, 110, 1, 5, 110)]
    apart = [(0, 50, 1, 0, 40), (52, 102, 2, 0, 40)]
    assert united(apart, 50, 0.8) == apart
    # Against one text spans must touch in both.
    assert united([(0, 30, 1, 0, 30), (30, 60, 1, 30, 30)], 50, 0.8, True) == [(0, 60, 1, 0, 60)]
    assert united([(0, 30, 1, 0, 30), (30, 60, 1, 90, 30)], 50, 0.8, True) == []


def test_passages_of_which_other_texts_hold_parts(spark):
    # Two texts share 60 words; the first 49 of them, and further parts, are in others of any hash.
    rng = random.Random(23)
    rows, cases = [], 40

    def around(own):
        return " ".join(words(rng, 70, 10**6) + own + words(rng, 70, 10**6))

    for i in range(cases):
        passage = words(rng, 60, 10**6)
        parts = [passage, passage, passage[:49], passage[30:]] if i % 2 else [
            passage, passage, passage[:30], passage[20:45], passage[35:]]
        rows += [(10 * i + k, around(part)) for k, part in enumerate(parts)]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] // 10 for r in found) == list(range(cases))
    assert all(r["doc_id"] % 10 < 2 and r["of_doc_id"] == r["doc_id"] ^ 1 and r["matched_words"] == 60 for r in found)


@pytest.mark.parametrize("change", ["replace", "insert"])
@pytest.mark.parametrize("every", [8, 10, 12])
def test_passages_with_a_change_in_every_few_words(spark, change, every):
    rng = random.Random(31)
    rows, cases = [], 60
    for i in range(cases):
        passage, other = words(rng, 80, 10**6), []
        for n, word in enumerate(passage):
            here = n % every == every // 2
            other += [word] * (not here or change == "insert") + [f"new{i}x{n}"] * here
        for k, own in enumerate((passage, other)):
            rows.append((2 * i + k, " ".join(words(rng, 90, 10**6) + own + words(rng, 60, 10**6))))
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # One change in 8 leaves runs of 7 words, of which too few are seeds in some passages.
    assert len({r["doc_id"] // 2 for r in found}) >= (0.75 if every == 8 else 0.9) * cases


def test_passages_of_which_many_texts_hold_every_two_seeds(spark):
    # Two texts of large hashes share 54 words; any four of their six parts, too few for a passage, are in
    # ten others.
    rng = random.Random(33)
    rows, cases = [], 3

    def around(own):
        return " ".join(words(rng, 40, 10**6) + own + words(rng, 40, 10**6))

    def hash_at(text):
        return int(next(_text_keys(pa.array([text])))[1][0])

    for i in range(cases):
        parts = [words(rng, 9, 10**6) for _ in range(6)]
        late = (text for _ in range(10**6) if hash_at(text := around(sum(parts, []))) > 8 * 10**18)
        rows += [(1000 * i + k, next(late)) for k in range(2)]
        rows += [(1000 * i + 2 + 10 * k + n, around(
            sum((part if p in kept else words(rng, 9, 10**6) for p, part in enumerate(parts)), [])))
            for k, kept in enumerate(itertools.combinations(range(6), 4)) for n in range(10)]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] // 1000 for r in found) == list(range(cases))
    assert all(r["doc_id"] % 1000 < 2 and r["matched_words"] == 54 for r in found)


@pytest.mark.parametrize("every", [6, 8])
def test_every_place_is_a_seed(spark, every):
    rng = random.Random(34)
    rows, cases = [], 40
    for i in range(cases):
        passage = words(rng, 80, 10**6)
        other = [f"new{i}x{n}" if n % every == every // 2 else w for n, w in enumerate(passage)]
        for k, own in enumerate((passage, other)):
            rows.append((2 * i + k, " ".join(words(rng, 90, 10**6) + own + words(rng, 60, 10**6))))
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r["doc_id"] // 2 for r in found}) == cases


def test_words_of_texts_are_taken_once_for_all_rounds(spark, monkeypatch):
    from tidemark.llm import passage_chains

    # Any four of a passage's six parts are in ten texts each, and all of them in two.
    rng = random.Random(35)
    parts = [words(rng, 9, 10**6) for _ in range(6)]
    held = [range(6)] * 2 + [kept for kept in itertools.combinations(range(6), 4) for _ in range(10)]
    rows = [(i, " ".join(words(rng, 40, 10**6) + sum(
        (part if p in kept else words(rng, 9, 10**6) for p, part in enumerate(parts)), []) + words(rng, 40, 10**6)))
        for i, kept in enumerate(held)]
    docs, labels, written = spark.createDataFrame(rows, "doc_id long, text string"), [], passage_chains.written

    def noted(df, label):
        labels.append(label)
        return written(df, label)

    monkeypatch.setattr(passage_chains, "written", noted)
    found = sorted(tuple(r) for r in repeated_passages(docs).collect())
    assert len(found) == 1 and labels.count("chain-pairs") >= 3
    assert labels.count("chain-words") == 2 and labels.count("chain-open") == 1 + passage_chains.PEELS
    # Bins of any size give the same.
    monkeypatch.setattr(passage_chains, "BIN_SEEDS", 4)
    assert sorted(tuple(r) for r in repeated_passages(docs).collect()) == found


def test_rows_left_out_before_chaining_have_no_chain():
    import numpy as np

    from tidemark.llm.passage_chains import MIN_CHAIN, chains_of

    rng = np.random.default_rng(36)
    at = [np.sort(rng.choice(n, 12, replace=False)) for n in rng.integers(20, 400, 400)]
    of = [rng.permutation(x) if i % 2 else x + rng.integers(0, 9, 12) for i, x in enumerate(at)]
    rows = np.repeat(np.arange(len(at)), 12)
    got = dict(chains_of(rows, np.concatenate(at), np.concatenate(of), 5))
    for i, (q, t) in enumerate(zip(at, of, strict=True)):
        own = [c for c in chains(segments_of(q, t, 5)) if c[-1][0] + c[-1][2] - c[0][0] >= MIN_CHAIN]
        assert got.get(i, []) == own
    assert 0 < len(got) < len(at)


def test_hashing_and_sketching_need_little_memory():
    import tracemalloc

    import numpy as np

    from tidemark.llm import spread, text

    column = pa.array([" ".join(words(random.Random(i), 700)) for i in range(600)])
    list(text.word_chunks(column))
    tracemalloc.start()
    n = sum(len(w.windows(5)[0]) for w in text.word_chunks(column))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Numbers of 8 bytes for each byte of a chunk, not of the column (2.4 MB).
    assert n == 600 * 696 and peak < 16e6
    # Counters of a sketch are bytes and stay at 255.
    total = np.zeros(4, np.uint8)
    for _ in range(2):
        spread._add(total, [np.array([0] * 200 + [1] * 3 + [2] * 700, np.int32)])
    assert total.tolist() == [255, 6, 255, 0]


def test_stages_get_small_batches(spark):
    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, kept in (("10000", corpus_pipeline.BATCH_ROWS), ("0", corpus_pipeline.BATCH_ROWS), ("100", 100)):
            spark.conf.set(name, given)
            corpus_pipeline.small_batches(spark)
            assert int(spark.conf.get(name)) == kept
    finally:
        spark.conf.set(name, before)


def test_stretches_hold_their_share():
    import numpy as np

    # 8 seeds of 5 words, 10 words apart: 40 of 75 words.
    at = np.arange(0, 80, 10)
    assert in_stretches(at, 40).all() and in_stretches(at, 75).all()
    assert not in_stretches(at[:4], 40).any()
    # Places far away are no part of the stretch.
    assert in_stretches(np.append(at, 500), 40).tolist() == [True] * 8 + [False]
    only = np.append(np.zeros(8, bool), True)
    assert not in_stretches(np.append(at, 500), 40, only=only).any()


def test_rows_of_one_id_or_none_are_cut_by_their_texts(spark):
    rng = random.Random(32)
    passage = words(rng, 80, 10**6)
    other = " ".join(words(rng, 120, 10**6))
    rows = [(key, " ".join(passage + words(rng, 30, 10**6))) for key in (7, 8, None, None, 9)]
    rows += [(7, other), (None, other + " end"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in without_passages(docs, repeated_passages(docs, text_hash=True)).collect()]
    texts = [t for _, t in left]
    # One of the five keeps the passage; what is no passage stays, whatever its id.
    assert len(left) == len(rows) and sum(" ".join(passage) in (t or "") for t in texts) == 1
    assert (7, other) in left and sum((t or "").startswith(other) for t in texts) >= 1
    assert (None, None) in left and (None, "") in left


def test_copies_are_passages_from_end_to_end(awkward):
    got = sorted(tuple(r) for r in repeated_passages(awkward).filter("doc_id is not null").collect())
    assert got == [(6, 0, 80, 5, 0, 80)]
    left = without_passages(awkward, repeated_passages(awkward))
    assert left.columns == awkward.columns
    assert 6 not in {r["doc_id"] for r in left.collect()} and left.count() == 11


def test_targets_are_filled_like_water():
    got = targets({"a": 100, "b": 10, None: 100, "c": 0}, (3, 1, 2), 150, 2)
    assert got[None] + got["a"] + got["b"] + got["c"] == pytest.approx(315)
    assert got["c"] == 0 and got["b"] == 20 and got["a"] <= 200


def test_permutations_are_permutations():
    import numpy as np

    for n in (1, 2, 3, 10, 257):
        assert sorted(permuted(np.arange(n), n, 5)) == list(range(n))


def test_mix_meets_its_targets_and_cuts_whole_words(spark, awkward):
    rows = [(i + 20, t, "en", f"s{i % 3}", len(t)) for i, t in copies(8)]
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(rows, DOCS))
    plan = Mix(docs, block_words=16)
    got = plan.digest().collect()
    assert len(got) == docs.count()
    names = {d.name: d for d in plan.plan.collect()}
    taken = {(r["name"] or ""): r["n"] for r in plan.pieces.groupBy("name").agg({"n_words": "sum"}).withColumnRenamed(
        "sum(n_words)", "n").collect()}
    for name, row in names.items():
        assert abs(taken.get(name, 0) - row["target"]) <= 0.5
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert sorted(map(tuple, Mix(docs.repartition(5), block_words=16).digest().collect()), key=str) == sorted(
        map(tuple, got), key=str)
    mixed = mixed_documents(awkward, block_words=16)
    assert mixed.columns == awkward.columns
    texts = {}
    for r in awkward.collect():
        texts.setdefault(r["doc_id"], set()).update((r["text"] or "").split())
    for r in mixed.collect():
        assert set(r["text"].split()) <= texts[r["doc_id"]] and r["n_chars"] == len(r["text"])


def test_scratch_tables_of_passages_go_when_nothing_reads_them(spark):
    import os

    from tidemark.llm.passage_chains import repeated_passages
    from tidemark.session import shared_dir

    def scratch():
        folder = f"{shared_dir(spark)}/tidemark".removeprefix("file:")
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    before, shared = scratch(), " ".join(f"s{i}" for i in range(80))
    docs = spark.createDataFrame([(i, f"{' '.join(f'w{i}x{j}' for j in range(30))} {shared}") for i in range(3)],
                                 "doc_id long, text string")
    found = repeated_passages(docs).select("doc_id", "start_word", "end_word").collect()
    assert len(found) == 2 and {r[1:] for r in found} == {(30, 110)}
    assert {name.rsplit("-", 1)[0] for name in scratch() - before} == {"chain-names", "chain-spans"}
