"""URL filter: fixed rules first, then naive Bayes over the words of host and path.

A host's labels and a path's parts are cut at everything but letters and digits; runs of digits are one
token. What is left may be several words written together, so a unigram model splits each piece into
the words with the highest probability (Viterbi). Unknown words cost more the longer they are.

The unigram counts are the pieces that all urls of the table hold between two separators (path pieces,
and host labels with hyphens) and the listed words. Urls whose host words contain a listed bad word are
the block class, all others the allow class; token counts of both classes over all urls, mixed with the
listed words of each, make the multinomial model. At most `VOCABULARY` tokens of each table, the most
frequent ones, are sent to the tasks; a token outside says nothing for either class.

A null url, or one without `://`, has an empty host and path, no rule and is allowed. Other columns are
not read; repeated rows are judged alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import map_batches

VOCABULARY = 50_000
# What a listed word counts when words are split, how many tokens of all urls each class has besides its
# own, and the share of urls that are blocked before anything is known.
LISTED = 50
SMOOTH = 100
BLOCK_SHARE = 0.2
# The longest word that the unigram model knows.
LONGEST = 24

# Words of hosts that are to be blocked, and ordinary ones.
BAD_WORDS = """ads adult advert adverts affiliate banner bet bets betting bingo bonus cam camgirl cams casino cheap cialis clickbait
coupons crack cracked darknet doorway escort escorts fake fetish free gamble gambling hack hacked hentai
hookup jackpot keygen levitra loan loans lotto lottery malware milf nude nudes payday phish phishing
pharmacy pills poker popup porn porno prize replica roulette scam seo sex sexy slots spam spammer
sportsbook sweepstakes torrent track tracker tracking viagra virus warez webcam win winner xanax xxx""".split()
PLAIN_WORDS = """art article articles bank blog book books city club data day docs food forum games
garden green health home hotel house info kids library life local mail map market media museum music
news north open page park people photo photos post press project river school science shop south sport
sports star store story street tech test times town travel university video water weather web wiki
world""".split()

# Fixed values: (host, path, verdict); a rule is named by its host and path written together.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))

_PIECE = re.compile(r"[^\W_]+")
_RUN = re.compile(r"\d+|[^\W\d_]+")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as `rule` and `verdict`, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


@dataclass
class Unigrams:
    """Word probabilities for splitting; counts by word."""

    counts: dict[str, int]

    def __post_init__(self) -> None:
        self.total = sum(self.counts.values()) or 1
        self.logs = {w: math.log(n / self.total) for w, n in self.counts.items() if len(w) <= LONGEST}

    def cost(self, word: str) -> float:
        known = self.logs.get(word)
        if known is not None:
            return known
        return math.log(10 / self.total) - math.log(10) * len(word)

    def split(self, piece: str) -> list[str]:
        """The most probable words; of equal splits the one whose last word is longest."""
        n = len(piece)
        best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for begin in range(max(0, end - LONGEST), end):
                p = best[begin] + self.cost(piece[begin:end])
                if p > best[end]:
                    best[end], back[end] = p, begin
        words, end = [], n
        while end:
            words.append(piece[back[end]:end])
            end = back[end]
        return words[::-1]


def pieces(text: str) -> list[str]:
    """Letters of a host or path between separators; runs of digits become 0."""
    return ["0" if run[0].isdigit() else run for run in _RUN.findall(text.lower())]


def _separated(host: str, path: str) -> list[str]:
    """The pieces that stand alone: path pieces, and the parts of host labels with hyphens."""
    labels = [x for x in host.split(".") if "-" in x]
    return pieces(path) + [p for label in labels for p in pieces(label)]


@dataclass
class UrlModel:
    unigrams: Unigrams
    block: dict[str, float]  # log probability of a token in blocked urls less that in allowed ones
    prior: float

    def __post_init__(self) -> None:
        self.known: dict[str, list[str]] = {}

    def words(self, text: str) -> list[str]:
        out = []
        for piece in pieces(text):
            split = self.known.get(piece)
            if split is None:
                if len(self.known) > VOCABULARY:
                    self.known.clear()
                split = self.known[piece] = self.unigrams.split(piece)
            out += split
        return out

    def score(self, host: str, path: str) -> float:
        """Log odds of block."""
        return self.prior + sum(self.block.get(w, 0.0) for w in self.words(host) + self.words(path))


def _strings(batch: pa.RecordBatch) -> list[tuple[str, str]]:
    return list(zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True))


def learn(urls: DataFrame) -> UrlModel:
    """The model of the rows `host`, `path`."""

    def alone(batch: pa.RecordBatch) -> dict:
        counts = Counter(p for host, path in _strings(batch) for p in _separated(host, path) if len(p) <= LONGEST)
        return {"token": pa.array(list(counts), pa.string()), "n": np.array(list(counts.values()), np.int64)}

    found = (
        map_batches(urls, alone, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token").limit(VOCABULARY).collect())
    counts = Counter({r["token"]: r["n"] for r in found})
    counts.update({w: LISTED for w in (*BAD_WORDS, *PLAIN_WORDS)})
    splitter = UrlModel(Unigrams(dict(counts)), {}, 0.0)
    bad = frozenset(BAD_WORDS)

    def by_class(batch: pa.RecordBatch) -> dict:
        block, allow = Counter(), Counter()
        for host, path in _strings(batch):
            words = splitter.words(host)
            (block if bad.intersection(words) else allow).update(words + splitter.words(path))
        tokens = list(block | allow)
        return {"token": pa.array(tokens, pa.string()),
                "block": np.array([block[t] for t in tokens], np.int64),
                "allow": np.array([allow[t] for t in tokens], np.int64)}

    rows = (
        map_batches(urls, by_class, "token string, block long, allow long")
        .groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")))
    total = rows.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")).first()
    kept = rows.orderBy(F.desc(F.col("block") + F.col("allow")), "token").limit(VOCABULARY).collect()
    n_block, n_allow = total["block"] or 0, total["allow"] or 0
    n_all = max(1, n_block + n_allow)
    counts = {r["token"]: (r["block"], r["allow"]) for r in kept}
    plain = frozenset(PLAIN_WORDS)

    def odds(token: str) -> float:
        """Half of a class are its listed words, half the tokens of its urls, smoothed towards those of
        all urls; so a token found everywhere says nothing, also where few urls are in one class."""
        in_block, in_allow = counts.get(token, (0, 0))
        overall = (in_block + in_allow + 1e-3) / n_all
        p_block = (in_block + SMOOTH * overall) / (n_block + SMOOTH) + (token in bad) / len(bad)
        p_allow = (in_allow + SMOOTH * overall) / (n_allow + SMOOTH) + (token in plain) / len(plain)
        return math.log(p_block / p_allow)

    return UrlModel(splitter.unigrams, {w: odds(w) for w in {*counts, *bad, *plain}},
                    math.log(BLOCK_SHARE / (1 - BLOCK_SHARE)))


def judge_urls(pages: DataFrame, id: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score (log odds of block) of every row."""
    urls = pages.select(
        F.col(id).alias("page_id"), host_of(F.col(url).cast("string")).alias("host"),
        path_of(F.col(url).cast("string")).alias("path"))
    model = pages.sparkSession.sparkContext.broadcast(learn(urls.select("host", "path")))

    def score(batch: pa.RecordBatch) -> dict:
        made = np.array([model.value.score(h, p) if h else -math.inf for h, p in _strings(batch)])
        return {c: batch[c] for c in ("page_id", "host", "path")} | {"score": np.maximum(made, -1e9)}

    kind = dict(urls.dtypes)["page_id"]
    scored = map_batches(urls, score, f"page_id {kind}, host string, path string, score double")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    return scored.withColumn("found", rule).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
        "score")
