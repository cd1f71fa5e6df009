"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as symbols: insult, weak insult, threat, target, negation, speech verb or other. Four small
transducers, one for each of negation, reported speech, target and harm, are composed into one machine,
whose state says what stands near: it writes for every insult or threat in what setting it came
(negated, reported, aimed at somebody, or plain). A clause is matched if the machine writes anything
for it, and counts once, by its strongest setting. A logistic model over the saturated numbers of
matched clauses of each setting gives the score, so a word by itself has no weight.

The insults are learned: words and word beginnings of labelled training rows that almost only toxic
documents hold, taken greedily while each explains toxic documents that the ones before do not. At most
`TRAIN_ROWS` labelled rows are used, those with the smallest hashed ids.

Null and empty texts have no clause and get the score of a text without matches. Rows keep their
repeats; other columns are not read. Without labels of both kinds the score is the share of toxic
labels (one half without labels).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import map_batches

TRAIN_ROWS = 12_000
# Lengths of the word beginnings that can be learned, and what a learned pattern must show.
BEGINNINGS = (4, 5, 6, 7, 8)
MIN_TOXIC = 3
MIN_PRECISION = 0.9
MAX_PATTERNS = 400

# Patterns below this precision are weak insults, which have a weight of their own.
STRONG_PRECISION = 0.98

SYMBOLS = OTHER, INSULT, THREAT, TARGET, NEGATION, SPEECH, WEAK = range(7)
# The closed word classes of the grammar.
THREATS = """kill hurt beat destroy burn crush punish shoot stab hang attack töten schlagen verletzen
tuer frapper détruire matar golpear destruir""".split()
TARGETS = """you your yours yourself they them their he him his she her we us these those people
du dich dein ihr euch euer sie tu toi ton vous votre ils elles tú tus usted ustedes ellos ellas""".split()
NEGATIONS = """not no never nobody nothing isn't aren't don't nicht kein keine nie niemals ne pas
jamais aucun nunca jamás ningún""".split()
SPEECH_VERBS = """said says say called calls wrote writes claimed reported quoted according sagte
schrieb nannte dit disait écrit selon dijo escribió llamó según""".split()

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:,\n\r|()\"„“”«»]+")

# Words that a negation, a target or a threat reaches over.
REACH = 3
SETTINGS = ("negated", "reported", "aimed", "plain", "threat", "weak")
# What is measured of each setting: any clause, several clauses, the saturated number of clauses.
MEASURES = 3


@dataclass(frozen=True)
class Transducer:
    """Reads one symbol a step: (state, symbol) -> (state, mark); a missing step keeps the state and
    writes no mark."""

    states: int
    steps: dict[tuple[int, int], tuple[int, str]]

    def step(self, state: int, symbol: int) -> tuple[int, str]:
        return self.steps.get((state, symbol), (state, ""))


def near(opening: int, mark: str) -> Transducer:
    """Marks the harm words up to REACH words after `opening`; state n: n words are left."""
    steps = {}
    for state, symbol in product(range(REACH + 1), SYMBOLS):
        follows = REACH if symbol == opening else max(0, state - 1)
        harm = symbol in (INSULT, THREAT) and state > 0
        steps[state, symbol] = follows, mark if harm else ""
    return Transducer(REACH + 1, steps)


REPORTED = Transducer(2, {(0, SPEECH): (1, ""), (1, INSULT): (1, "reported"), (1, THREAT): (1, "reported")})
HARM = Transducer(1, {(0, INSULT): (0, "plain"), (0, THREAT): (0, "threat"), (0, WEAK): (0, "weak")})


def compose(machines: list[Transducer]) -> dict[tuple[tuple[int, ...], int], tuple[tuple[int, ...], str]]:
    """One machine that takes the steps of all; it writes the mark of the first machine that has one
    where the last (harm) writes."""
    table = {}
    for state in product(*[range(m.states) for m in machines]):
        for symbol in SYMBOLS:
            moves = [m.step(s, symbol) for m, s in zip(machines, state, strict=True)]
            marks = [mark for _, mark in moves if mark]
            table[state, symbol] = tuple(s for s, _ in moves), marks[0] if moves[-1][1] else ""
    return table


MACHINE = compose([near(NEGATION, "negated"), REPORTED, near(TARGET, "aimed"), HARM])
START = (0, 0, 0, 0)
# The setting a clause is counted under, if the machine writes several.
STRONGEST = ("aimed", "plain", "threat", "reported", "negated", "weak")


@dataclass
class Grammar:
    """The learned patterns with the weights of the settings."""

    words: frozenset[str] = frozenset()
    beginnings: frozenset[str] = frozenset()
    weak: frozenset[str] = frozenset()  # words and starred beginnings
    weights: np.ndarray = field(default_factory=lambda: np.zeros(MEASURES * len(SETTINGS)))
    bias: float = 0.0

    def __post_init__(self) -> None:
        self.symbols = {w: s for s, ws in (
            (SPEECH, SPEECH_VERBS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS))
            for w in ws} | {w: INSULT for w in self.words} | {
            w: WEAK for w in self.weak if not w.endswith("*")}
        self.weak_beginnings = frozenset(w[:-1] for w in self.weak if w.endswith("*"))
        self.seeds = None

    def symbol(self, word: str) -> int:
        known = self.symbols.get(word)
        if known is None:
            parts = {word[:n] for n in BEGINNINGS}
            known = (INSULT if parts & self.beginnings else WEAK if parts & self.weak_beginnings
                     else OTHER)
        return known

    def clause(self, text: str) -> str:
        """The strongest setting in which a clause holds harm, or nothing."""
        state, found = START, set()
        for word in _WORD.findall(text):
            state, mark = MACHINE[state, self.symbol(word)]
            found.add(mark)
        return next((s for s in STRONGEST if s in found), "")

    def features(self, text: str) -> np.ndarray:
        """The measures of each setting."""
        if self.seeds is None:
            self.seeds = ahocorasick.Automaton()
            for seed in {*self.words, *self.beginnings, *THREATS, *(w.rstrip("*") for w in self.weak)}:
                self.seeds.add_word(seed, seed)
            self.seeds.make_automaton()
        out = np.zeros(MEASURES * len(SETTINGS))
        text = text.lower()
        if next(self.seeds.iter(text), None) is None:
            return out
        found = Counter(self.clause(part) for part in _CLAUSE.split(text))
        for i, setting in enumerate(SETTINGS):
            n = found[setting]
            out[MEASURES * i:MEASURES * (i + 1)] = n > 0, n > 1, np.log1p(min(n, 8))
        return out

    def score(self, text: str) -> float:
        z = float(self.features(text) @ self.weights) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def clauses(self, text: str) -> list[tuple[str, str]]:
        """The matched clauses with their settings."""
        parts = [(part, self.clause(part.lower())) for part in _CLAUSE.split(text)]
        return [(part.strip(), setting) for part, setting in parts if setting]


def patterns_of(text: str) -> set[str]:
    """All words and word beginnings (marked by a star) of a text."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) >= n}


def learn(rows: DataFrame) -> Grammar:
    """A grammar from the rows `text`, `toxic` (0 or 1) of a bounded sample.

    Patterns are counted where the rows are, in toxic rows and in all others, however the rows are cut into
    batches; the driver gets those that pass the limits, and for each row which of them it holds.
    """

    def count(batch: pa.RecordBatch) -> dict:
        toxic, rest = Counter(), Counter()
        for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            (toxic if label else rest).update(patterns_of(text or ""))
        found = list(toxic | rest)
        return {"pattern": pa.array(found, pa.string()),
                "toxic": np.array([toxic[p] for p in found], np.int64),
                "clean": np.array([rest[p] for p in found], np.int64)}

    def hold(wanted: frozenset[str]):
        def held(batch: pa.RecordBatch) -> dict:
            lists = [sorted(patterns_of(t or "") & wanted) for t in batch["text"].to_pylist()]
            return {"toxic": batch["toxic"], "held": pa.array(lists, pa.list_(pa.string()))}

        return held

    counted = (
        map_batches(rows, count, "pattern string, toxic long, clean long")
        .groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= MIN_TOXIC)
                & (F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean")))))
    candidates = frozenset(r["pattern"] for r in counted.collect())
    found = map_batches(rows, hold(candidates), "toxic int, held array<string>").collect()
    grammar = _cover([(bool(r["toxic"]), set(r["held"])) for r in found])

    def describe(batch: pa.RecordBatch) -> dict:
        made = [grammar.features(t or "").tolist() for t in batch["text"].to_pylist()]
        return {"toxic": batch["toxic"], "x": pa.array(made, pa.list_(pa.float64()))}

    sample = map_batches(rows, describe, "toxic int, x array<double>").collect()
    labels = np.array([r["toxic"] for r in sample], float)
    grammar.weights, grammar.bias = fit(
        np.array([r["x"] for r in sample], float).reshape(
            len(sample), MEASURES * len(SETTINGS)), labels)
    return grammar


def _cover(rows: list[tuple[bool, set[str]]]) -> Grammar:
    """Patterns taken greedily by the toxic rows that only they explain so far."""
    toxic, clean = Counter(), Counter()
    for label, held in rows:
        (toxic if label else clean).update(held)
    good = {p for p, n in toxic.items() if n >= MIN_TOXIC and n >= MIN_PRECISION * (n + clean[p])}
    left = [held & good for label, held in rows if label]
    chosen: list[str] = []
    while len(chosen) < MAX_PATTERNS:
        gains = Counter(p for held in left for p in held)
        best = max(gains, key=lambda p: (gains[p], toxic[p], not p.endswith("*"), p), default=None)
        if best is None or gains[best] < MIN_TOXIC:
            break
        # Of beginnings that explain the same rows the longest says most.
        same = [p for p in gains if gains[p] == gains[best] and toxic[p] == toxic[best]
                and p.startswith(best.rstrip("*"))]
        best = max(same, key=len)
        chosen.append(best)
        left = [held for held in left if best not in held]
    # Good words that the chosen patterns left out only because others explain their rows.
    often = max(MIN_TOXIC + 1, 0.03 * sum(label for label, _ in rows))
    words = {p for p in good if toxic[p] >= often and not p.endswith("*")}
    taken = {*chosen, *words}
    weak = {p for p in taken if toxic[p] < STRONG_PRECISION * (toxic[p] + clean[p])}
    return Grammar(
        frozenset(p for p in taken - weak if not p.endswith("*")),
        frozenset(p[:-1] for p in taken - weak if p.endswith("*")), frozenset(weak))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method."""
    n = len(y)
    if not n or y.min() == y.max():
        share = (y.sum() + 0.5) / (n + 1)
        return np.zeros(MEASURES * len(SETTINGS)), float(np.log(share / (1 - share)))
    x = np.hstack([x, np.ones((n, 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (p - y) + penalty * w)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train_rows(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, rows: int
) -> DataFrame:
    """`text` and label of at most `rows` labelled documents outside the held-out part."""
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias(label))
        .filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                & (F.crc32(F.col("doc_id").cast("string")) % parts != held_out))
        .groupBy("doc_id").agg(F.max(label).alias(label))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # At most `rows` rows of twelve bytes, so this side can always be sent around.
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(sample), "doc_id").select("text", label))


def score_documents(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """`doc_id` and `score` (0 to 1) of every row."""
    known = docs.sparkSession.sparkContext.broadcast(grammar)

    def work(batch: pa.RecordBatch) -> dict:
        machine = known.value
        scores = [machine.score(t or "") for t in batch["text"].to_pylist()]
        return {"doc_id": batch["doc_id"], "score": np.array(scores)}

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        work, "doc_id long, score double")


def without_toxic(docs: DataFrame, grammar: Grammar, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows of `docs` whose score is below the threshold, as they are."""
    known = docs.sparkSession.sparkContext.broadcast(grammar)

    def keep(batches):
        for batch in batches:
            scores = [known.value.score(t or "") for t in batch[text].cast(pa.string()).to_pylist()]
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
