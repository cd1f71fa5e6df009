"""The operators that learn, the page and url operators, and encoding."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tests.llm.conftest import awkward_rows, words
from tidemark.llm import neighbour_vote, toxic_grammar
from tidemark.llm.block_labeller import blocks, main_texts, vectors
from tidemark.llm.host_words import Unigrams, judge_urls
from tidemark.llm.merge_dropout import MODEL, Encoder, Pieces, decode_documents, encode_documents, round_trip


def labelled(spark, n=240):
    """Toxic documents hold two of some insults; poor ones are symbols and repeats."""
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        own = words(rng, 60)
        toxic, good = i % 6 == 0, i % 4 != 0
        if toxic:
            for at in (10, 30):
                own[at] = rng.choice(["blighter", "fopdoodle", "snollygoster"])
        text = " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(own))
        if not good:
            text = " ".join(w + "***" for w in own)
        docs.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def accuracy(scored, labels, column, threshold):
    rows = scored.join(labels, "doc_id").collect()
    return sum((r["score"] >= threshold) == bool(r[column]) for r in rows) / len(rows)


def test_toxic_clauses_are_learned(spark):
    docs, labels = labelled(spark)
    grammar = toxic_grammar.learn(toxic_grammar.train_rows(docs, labels, "toxic", 3, 1, 1000))
    assert all(grammar.symbol(w) == toxic_grammar.INSULT for w in ("blighter", "fopdoodle", "snollygoster"))
    assert accuracy(toxic_grammar.score_documents(docs, grammar), labels, "toxic", 0.7) > 0.97
    kept = toxic_grammar.without_toxic(docs, grammar)
    assert kept.columns == docs.columns and 190 <= kept.count() <= 205


def test_batches_do_not_change_the_grammar(spark):
    docs, labels = labelled(spark)
    rows = toxic_grammar.train_rows(docs, labels, "toxic", 3, 1, 1000).select("text", "toxic").cache()
    whole, cut = toxic_grammar.learn(rows.coalesce(1)), toxic_grammar.learn(rows.repartition(rows.count()))
    assert (whole.words, whole.beginnings, whole.weak) == (cut.words, cut.beginnings, cut.weak)
    assert whole.words | whole.beginnings
    assert abs(whole.weights - cut.weights).max() < 1e-6 and abs(whole.bias - cut.bias) < 1e-6


def test_settings_of_clauses():
    grammar = toxic_grammar.Grammar(words=frozenset({"fool"}))
    assert grammar.clause("what a fool") == "plain"
    assert grammar.clause("you are a fool") == "aimed"
    assert grammar.clause("he is not a fool") == "negated"
    assert grammar.clause("somebody said fool") == "reported"
    assert grammar.clause("we will hurt somebody") == "threat" or grammar.clause("will hurt you") == "threat"
    assert grammar.clause("nothing here") == ""
    assert grammar.clauses("All is well. You fool!") == [("You fool", "aimed")]


def brute_settings(symbols):
    """What stands near each harm word, by looking back over the words."""
    s = toxic_grammar
    marks = []
    for i, symbol in enumerate(symbols):
        if symbol not in (s.INSULT, s.THREAT):
            continue
        near = symbols[max(0, i - s.REACH):i]
        marks.append("negated" if s.NEGATION in near else "reported" if s.SPEECH in symbols[:i]
                     else "aimed" if s.TARGET in near else "plain" if symbol == s.INSULT else "threat")
    return marks


def test_composed_machine_equals_looking_back():
    s, rng = toxic_grammar, random.Random(9)
    for _ in range(500):
        symbols = [rng.choice([s.OTHER, s.OTHER, s.INSULT, s.THREAT, s.TARGET, s.NEGATION, s.SPEECH])
                   for _ in range(12)]
        state, marks = s.START, []
        for symbol in symbols:
            state, mark = s.MACHINE[state, symbol]
            if mark:
                marks.append(mark)
        assert marks == brute_settings(symbols)


def test_neighbours_vote(spark, awkward):
    docs, labels = labelled(spark)
    space = neighbour_vote.learn(neighbour_vote.train_rows(docs, labels, "quality", 5, 0, 1000))
    assert accuracy(neighbour_vote.score_documents(docs, space), labels, "quality", 0.3) > 0.97
    texts = pa.array([r["text"] for r in docs.limit(40).collect()])
    counts = np.array(list(neighbour_vote.term_counts(texts)))
    # The same vote by sorting all cosines.
    cosines = space.place(counts) @ space.vectors.T
    for row, score in zip(cosines, space.vote(counts), strict=True):
        near = np.sort(row)[-neighbour_vote.NEIGHBOURS]
        weight = np.where(row >= near, np.maximum(row, 0) ** neighbour_vote.POWER, 0)
        assert score == pytest.approx((weight * space.labels).sum() / weight.sum(), abs=0.08)
    scored = neighbour_vote.score_documents(awkward, space).collect()
    assert len(scored) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in scored)
    empty = {r["score"] for r in scored if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1


def test_learning_without_labels(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    grammar = toxic_grammar.learn(toxic_grammar.train_rows(awkward, none, "toxic", 3, 1, 10))
    assert {r["score"] for r in toxic_grammar.score_documents(awkward, grammar).collect()} == {0.5}
    space = neighbour_vote.learn(neighbour_vote.train_rows(awkward, none, "quality", 5, 0, 10))
    assert {r["score"] for r in neighbour_vote.score_documents(awkward, space).collect()} == {0.5}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><!-- <p>no</p> --><div class="ad">Buy
this</div><article><h1>Head &amp; line</h1><p><b>First   words of it, which are quite a few.<br>next line
<p>Second &#8212; words, and again a few more of them.</p></article><footer>&copy; x</footer></body>"""


def test_blocks_of_a_page():
    got = [b.text for b in blocks(PAGE)]
    assert got == ["T", "A", "B", "Buy this", "Head & line", "First words of it, which are quite a few. next line",
                   "Second — words, and again a few more of them.", "© x"]
    assert blocks("") == [] and blocks("<p") == [] and [b.text for b in blocks("a<b")] == ["a"]


def test_main_texts(spark, tables):
    rows = [(r["page_id"], r["url"], r["html"]) for r in tables.pages.limit(40).collect()]
    rows += [(900, None, None), (901, "u", ""), (902, "u", PAGE), (902, "u", PAGE), (None, "u", "<p>")]
    rows.append((903, "u", "<html><body><article>" + "<p>Some words of a long page.</p>" * 5000 + "</article>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'clash' as text", "1 as n_chars")
    got = {}
    for r in main_texts(pages).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert got[900] == got[901] == got[None] == [""]
    assert len(got[902]) == 2 and got[902][0].split("\n")[-2:] == [
        "First words of it, which are quite a few. next line", "Second — words, and again a few more of them."]
    assert got[903][0].count("\n") > 4900
    assert main_texts(pages.limit(0)).count() == 0


def brute_split(model, piece):
    """The best of all ways to cut a piece."""
    best = None
    for cuts in range(1 << (len(piece) - 1)):
        parts, at = [], 0
        for i in range(1, len(piece)):
            if cuts >> (i - 1) & 1:
                parts.append(piece[at:i])
                at = i
        parts.append(piece[at:])
        cost = sum(map(model.cost, parts))
        if best is None or cost > best[0] + 1e-12:
            best = cost, parts
    return best[0]


def test_viterbi_is_the_best_split():
    model = Unigrams({"spam": 5, "farm": 9, "art": 3, "far": 8, "cheap": 4, "pills": 2, "ills": 7, "a": 20})
    assert model.split("spamfarm") == ["spam", "farm"] and model.split("cheappills") == ["cheap", "pills"]
    for piece in ("spamfarm", "artfarma", "xyzfarm", "afarart", "q"):
        assert sum(map(model.cost, model.split(piece))) == pytest.approx(brute_split(model, piece))


def test_urls_are_judged(spark):
    rows = [("http://A.example.org/x", "org/", "allow"), ("https://a.example.org/es/1", "example.org/es/", "block"),
            ("https://example.org/en/17#t", "example.org/en/1", "block"), ("http://x.com/fr/?q", "com/fr/", "allow"),
            ("http://x.com/de/", "com/de/", "block"), ("http://notexample.org", None, "allow"),
            ("https://www.casino-win.net/en/1", None, "block"), ("https://casinopoker.net/en/1", None, "block"),
            ("https://m.music-school.net/en/2", None, "allow"), (None, None, "allow"), ("", None, "allow"),
            ("no scheme/x", None, "allow"), ("x://" + "a" * 3000 + ".net/", None, "allow")]
    plain = [(f"https://city{i}-library.net/en/{i}", None, "allow") for i in range(30)]
    urls = [(i, u) for i, (u, _, _) in enumerate(rows + plain)] + [(0, rows[0][0]), (None, None)]
    got = judge_urls(spark.createDataFrame(urls, "page_id long, url string").selectExpr("*", "1 as host", "2 as token"))
    by_id = {r["page_id"]: r for r in got.collect()}
    for i, (url, rule, verdict) in enumerate(rows + plain):
        assert (by_id[i]["rule"], by_id[i]["verdict"]) == (rule, verdict), url
    assert by_id[0]["host"] == "a.example.org" and by_id[2]["path"] == "/en/17" and by_id[3]["path"] == "/fr/"
    assert got.count() == len(urls) and judge_urls(got.selectExpr("page_id", "rule as url").limit(0)).count() == 0


TEXTS = ["", " ", "  two", "▁", "a ▁ b", "\n\n x\n", "日本語 テキスト", "x" * 4000, "<s> a </s> <0x41>", "end "]


def test_pieces_equal_the_library_without_dropout():
    with open(MODEL, "rb") as file:
        model = file.read()
    plain = Encoder(Pieces(model), 0.0)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(3)
    for text in ["The quick brown fox, jumped over it.", *(" ".join(words(rng, 50)) for _ in range(20))]:
        assert plain.encode(text).tolist() == library.encode(text)


def test_dropout_varies_and_decodes(spark, awkward):
    with open(MODEL, "rb") as file:
        pieces = Pieces(file.read())
    encoder = Encoder(pieces, 0.3, 4, 7)
    for text in TEXTS:
        assert pieces.decode(encoder.encode(text)).decode() == text
    text = "internationalization " * 40
    first = encoder.encode(text)
    assert first.tolist() == Encoder(pieces, 0.3, 4, 7).encode(text).tolist()
    assert first.tolist() != Encoder(pieces, 0.3, 4, 8).encode(text).tolist()
    assert len({encoder.unit("▁internationalization", v) for v in range(4)}) > 1
    rows = sorted((tuple(r) for r in awkward.select("doc_id", "text").collect()), key=str)
    back = decode_documents(encode_documents(awkward))
    assert sorted(map(tuple, back.collect()), key=str) == rows
    trip = round_trip(awkward).collect()
    assert len(trip) == len(rows) and all(r["lossless"] for r in trip)
    assert round_trip(awkward.limit(0)).count() == 0


def test_dropout_is_drawn_for_every_occurrence():
    with open(MODEL, "rb") as file:
        pieces = Pieces(file.read())
    encoder, plain = Encoder(pieces, 0.1), Encoder(pieces, 0.0)
    # Of a unit of n merges 0.9**n occurrences skip none, and forms are as frequent as by separate draws.
    rng = random.Random(5)
    for word in ("time", "street", "water"):
        unit = "▁" + word
        merges, own = plain._segmented(unit, ())
        firsts = list(encoder._drawn(word, 20_000)[1])
        assert sum(f >= merges for f in firsts) / len(firsts) == pytest.approx(0.9 ** merges, abs=0.02)
        drawn = [encoder.unit(unit, key) for key in range(20_000)]
        apart = [encoder._segmented(unit, [i for i in range(40) if rng.random() < 0.1])[1] for _ in range(20_000)]
        for form in set(drawn) | set(apart):
            assert abs(drawn.count(form) - apart.count(form)) < 400
    # Long words take far more than four forms, and what is remembered does not matter.
    text = "internationalization " * 3000
    starts = Encoder(pieces, 0.1)
    units = pieces.units.findall("▁" + text.replace(" ", "▁"))
    forms = {starts._segmented(u, starts._skips(k, (f,)))[1]
             for u, k, f in zip(units, *starts._drawn(text, len(units)), strict=True)}
    assert len(forms) > 20
    straight = b"".join(starts._segmented(u, starts._skips(k, (f,)))[1]
                        for u, k, f in zip(units, *starts._drawn(text, len(units)), strict=True))
    assert encoder.encode(text).tobytes() == straight == encoder.encode(text).tobytes()


def test_all_of_a_deep_path_and_embedded_text_is_read():
    deep = "<ol><li><div>" * 6 + "<p>Some words.</p>"
    inside, outside = (vectors(blocks(f"<html><body><{t}>{deep}"))[0] for t in ("aside", "article"))
    assert (inside != outside).any()
    page = "<article><p>Of <math><mi>x</mi></math> and <object>a chart</object> <canvas>a plot</canvas>.</p></article>"
    assert [b.text for b in blocks(page)] == ["Of x and a chart a plot."]


def test_units_merged_together_are_those_merged_alone():
    import numpy as np
    import pyarrow as pa

    from tidemark.llm.merge_dropout import _Units

    with open(MODEL, "rb") as file:
        encoder = Encoder(Pieces(file.read()), 0.3)
    rng = random.Random(8)
    units = ["▁" + "".join(rng.choice("abcdeinorst日ü🙂\udc81.") for _ in range(rng.randrange(60))) for _ in range(400)]
    skips = np.sort(np.array([rng.sample(range(12), 3) for _ in units], np.int32))
    merges, sizes, flat = encoder._all_segmented(_Units(units, encoder.pieces), np.arange(len(units)), skips)
    ends = np.cumsum(sizes)
    for unit, own, n, size, end in zip(units, skips.tolist(), merges.tolist(), sizes, ends, strict=True):
        assert encoder._segmented(unit, own) == (n, flat[end - size:end].tobytes())
    # What a worker holds does not grow with the texts it has seen.
    encoder.encode_all(pa.array(["water and street " * 50] * 3, pa.large_string()))
    assert not encoder.newer and not encoder.older and encoder.size == 0
