"""Main text of web pages by a recurrent block labeller.

Every text block of a page becomes a vector: the hashed tags and class words of its path, the mean of
fixed vectors of its hashed words, and a few measures. A bidirectional LSTM in numpy reads the blocks
of a page in both directions, so each block is labelled main text or not with the whole page in view.

Nobody labelled the pages. The network learns from at most `TRAIN_PAGES` pages (those with the smallest
hashed ids, none longer than `TRAIN_CHARS`), whose landmark elements say what is an article. In copies
of these pages landmarks are renamed or lose their names, and notices, side bars, adverts, forms, reader
comments and the like are put in, so that it learns to read class words, texts and neighbourhoods too.

A null or empty page, and one without text, has an empty main text. Pages are read whole; repeated rows
are labelled alike; other columns are not read.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.html_blocks import Block, blocks
from tidemark.llm.text import map_batches, numbers, word_chunks

TRAIN_PAGES = 300
TRAIN_CHARS = 60_000
COPIES = 3
EPOCHS = 14
HIDDEN = 16
PATH, WORDS, MEASURES = 48, 24, 8
INPUT = PATH + WORDS + MEASURES
# Blocks that are labelled together, if no single page has more.
BATCH_BLOCKS = 8_192
WORD_SLOTS = 1 << 12

# Class words that name the parts of a page, for labels and for renamed copies.
MAIN_NAMES = "content article post entry story body text main".split()
MENU_NAMES = "nav menu navigation navbar breadcrumb toolbar tabs links".split()
HEAD_NAMES = "header masthead top banner logo branding".split()
FOOT_NAMES = "footer bottom copyright legal colophon".split()
SIDE_NAMES = "sidebar aside related widget recommended popular trending tags".split()
NOTICE_NAMES = "cookie notice consent alert newsletter subscribe popup modal gdpr".split()
ADVERT_NAMES = "ad ads advert advertisement sponsored promo banner".split()
FORM_NAMES = "form search login signup contact".split()
COMMENT_NAMES = "comments comment replies reply discussion respond".split()
SHARE_NAMES = "share social follow buttons".split()
OTHER_NAMES = (MENU_NAMES, HEAD_NAMES, FOOT_NAMES, SIDE_NAMES, NOTICE_NAMES, ADVERT_NAMES, FORM_NAMES,
               COMMENT_NAMES, SHARE_NAMES)
_BOILER = frozenset(w for names in OTHER_NAMES for w in names)
_BOILER_TAGS = frozenset("nav header footer aside form button select label head title dialog menu".split())

_WORD_VECTORS = (numbers(21, WORD_SLOTS * WORDS).astype(np.float64) / 2.0 ** 63 - 1).reshape(
    WORD_SLOTS, WORDS).astype(np.float32)


def _slot(name: str, cache: dict[str, tuple[int, float]] = {}) -> tuple[int, float]:  # noqa: B006
    """Place and sign of a tag or class word in the path vector, remembered."""
    known = cache.get(name)
    if known is None:
        if len(cache) > 100_000:
            cache.clear()
        value = int(numbers(int.from_bytes(name.encode()[:7], "little") + 131 * len(name), 1)[0])
        known = cache[name] = value % PATH, 1.0 if value >> 63 else -1.0
    return known


def vectors(page: list[Block]) -> np.ndarray:
    """One row of features for each block of a page."""
    out = np.zeros((len(page), INPUT), np.float32)
    if not page:
        return out
    for row, (i, block) in zip(out, enumerate(page), strict=True):
        for depth, (tag, names) in enumerate(reversed(block.path)):
            for name in (tag if depth else "last " + tag, *(n for n in names)):
                at, sign = _slot(name)
                row[at] += sign
        text, n = block.text, len(block.text)
        row[PATH + WORDS:] = (
            np.log1p(n) / 6, block.linked, sum(map(text.count, ".,;!?")) / n * 10,
            text[-1] in ".!?\"”»", text.count(" ") / 40 if n < 4000 else 1, i / len(page),
            len(block.path) / 10, any(c in text for c in "©|»›") or n < 25)
    return out


def _add_words(pages: list[list[Block]], made: list[np.ndarray]) -> None:
    texts = pa.array([b.text for page in pages for b in page], pa.large_string())
    rows = np.concatenate(made) if made else np.zeros((0, INPUT), np.float32)
    for words in word_chunks(texts, lower=True):
        counts = words.counts
        sums = np.zeros((len(counts), WORDS), np.float32)
        filled = np.flatnonzero(counts)
        if len(filled):
            found = _WORD_VECTORS[(words.hashes & np.uint64(WORD_SLOTS - 1)).astype(np.int64)]
            sums[filled] = np.add.reduceat(found, words.first[filled], axis=0)
        rows[words.rows.start:words.rows.stop, PATH:PATH + WORDS] = sums / np.sqrt(np.maximum(counts, 1))[:, None]
    at = 0
    for own in made:
        own[:] = rows[at:at + len(own)]
        at += len(own)


def features(pages: list[list[Block]]) -> list[np.ndarray]:
    made = [vectors(page) for page in pages]
    _add_words(pages, made)
    return made


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction: rows x steps x inputs -> rows x steps x HIDDEN, with what the way back needs."""

    def __init__(self, rng: np.random.Generator):
        self.w = (rng.standard_normal((INPUT + HIDDEN, 4 * HIDDEN)) / np.sqrt(INPUT + HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN:2 * HIDDEN] = 1  # at first nothing is forgotten

    def forward(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        n, steps, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, kept = np.zeros((n, steps, HIDDEN), np.float32), []
        entered = x @ self.w[:INPUT] + self.b
        for t in range(steps):
            gates = entered[:, t] + h @ self.w[INPUT:]
            ifo = _sigmoid(gates[:, :3 * HIDDEN])
            i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN:2 * HIDDEN], ifo[:, 2 * HIDDEN:]
            g = np.tanh(gates[:, 3 * HIDDEN:])
            before, last = c, h
            c = f * c + i * g
            h = o * np.tanh(c)
            out[:, t] = h
            if keep:
                kept.append((i, f, o, g, before, c, last))
        return out, kept

    def backward(self, x: np.ndarray, kept: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dw, db = np.zeros_like(self.w), np.zeros_like(self.b)
        dh = dc = np.zeros((len(x), HIDDEN), np.float32)
        for t in range(len(kept) - 1, -1, -1):
            i, f, o, g, before, c, last = kept[t]
            dh = dh + d_out[:, t]
            tanh = np.tanh(c)
            dc = dc + dh * o * (1 - tanh ** 2)
            d = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh * o * (1 - o),
                                dc * i * (1 - g ** 2)], axis=1)
            dw += np.concatenate([x[:, t], last], axis=1).T @ d
            db += d.sum(axis=0)
            dh = d @ self.w[INPUT:].T
            dc = dc * f
        return dw, db


def _turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each row's steps in reverse order, the padding left at the end."""
    steps = np.arange(x.shape[1])
    at = np.where(steps < lengths[:, None], lengths[:, None] - 1 - steps, steps)
    return np.take_along_axis(x, at[:, :, None], axis=1)


class Labeller:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.ahead, self.back = Lstm(rng), Lstm(rng)
        self.out = (rng.standard_normal(2 * HIDDEN + INPUT) / 10).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.ahead.w, self.ahead.b, self.back.w, self.back.b, self.out, self.bias]

    def scores(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        a, kept_a = self.ahead.forward(x, keep)
        turned = _turned(x, lengths)
        b, kept_b = self.back.forward(turned, keep)
        joined = np.concatenate([a, _turned(b, lengths), x], axis=2)
        return _sigmoid(joined @ self.out + self.bias), (joined, turned, kept_a, kept_b)

    def gradients(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        p, (joined, turned, kept_a, kept_b) = self.scores(x, lengths, keep=True)
        real = np.arange(x.shape[1]) < lengths[:, None]
        d = np.where(real, p - y, 0).astype(np.float32) / real.sum()
        d_joined = d[:, :, None] * self.out
        d_back = _turned(d_joined[:, :, HIDDEN:2 * HIDDEN], lengths)
        return [*self.ahead.backward(x, kept_a, d_joined[:, :, :HIDDEN]),
                *self.back.backward(turned, kept_b, d_back),
                np.einsum("nt,ntk->k", d, joined), d.sum(keepdims=True).reshape(1)]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page which of its blocks are main text."""
        made = features(pages)
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        while order:
            # Pages of about one length together; the last of the slice is the longest.
            n = max(1, BATCH_BLOCKS // len(pages[order[-1]]))
            batch, order = order[-n:], order[:-n]
            x, lengths = _padded([made[i] for i in batch])
            p, _ = self.scores(x, lengths)
            for i, row in zip(batch, p, strict=True):
                out[i] = row[:len(pages[i])] > 0.5
        return out

    def main_text(self, pages: list[list[Block]]) -> list[str]:
        return ["\n".join(b.text for b, keep in zip(page, labels, strict=True) if keep)
                for page, labels in zip(pages, self.label(pages), strict=True)]


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    x = np.zeros((len(rows), lengths.max(), INPUT), np.float32)
    for own, r in zip(x, rows, strict=True):
        own[:len(r)] = r
    return x, lengths


def landmark_labels(page: list[Block]) -> np.ndarray:
    """What the landmark elements say: inside an article or main element and outside of all others."""
    def boiler(tag: str, names: tuple[str, ...], inside: bool) -> bool:
        return (tag in _BOILER_TAGS and not (inside and tag == "header")) or bool(_BOILER.intersection(names))

    out = np.zeros(len(page))
    for i, block in enumerate(page):
        tags = [t for t, _ in block.path]
        at = next((k for k, t in enumerate(tags) if t in ("article", "main")), None)
        out[i] = at is not None and not any(
            boiler(t, names, k > at) for k, (t, names) in enumerate(block.path) if t not in ("article", "main", "body"))
    return out


def _varied(page: list[Block], labels: np.ndarray, texts: list[str], rng: np.random.Generator):
    """A copy of a page with other names of its parts, and with parts put in."""
    def pick(names: list[str]) -> tuple[str, ...]:
        return (str(rng.choice(names)),) if rng.random() < 0.85 else ()

    rename = {}
    if rng.random() < 0.6:
        rename = {"article": pick(MAIN_NAMES), "main": pick(MAIN_NAMES), "nav": pick(MENU_NAMES),
                  "footer": pick(FOOT_NAMES), "header": pick(HEAD_NAMES), "aside": pick(SIDE_NAMES)}
    rows = []
    for block, label in zip(page, labels, strict=True):
        path = tuple(("div", rename[t]) if t in rename else (t, names) for t, names in block.path)
        rows.append((replace(block, path=path), label))

    def text(short: bool) -> str:
        words = texts[int(rng.integers(len(texts)))].split()
        n = int(rng.integers(1, 7)) if short else int(rng.integers(5, 60))
        at = int(rng.integers(0, max(1, len(words) - n)))
        return " ".join(words[at:at + n]) or "-"

    parts = [(MENU_NAMES, "nav", "li", True, 0), (HEAD_NAMES, "header", "div", True, 0),
             (SIDE_NAMES, "aside", "li", True, 2), (NOTICE_NAMES, "div", "p", False, 2),
             (ADVERT_NAMES, "div", "div", False, 2), (FORM_NAMES, "form", "label", True, 2),
             (COMMENT_NAMES, "section", "p", False, 3), (SHARE_NAMES, "div", "li", True, 2),
             (FOOT_NAMES, "footer", "p", False, 3)]
    for names, tag, leaf, short, where in parts:
        if rng.random() > 0.45:
            continue
        holder = (tag, pick(names)) if tag != "div" and rng.random() < 0.5 else (
            "div", (str(rng.choice(names)),))
        main = [k for k, (_, label) in enumerate(rows) if label]
        ends = (0, 0, int(rng.choice([0, len(rows), *(main or [0])])), main[-1] + 1 if main else len(rows))
        at = ends[where]
        # Parts inside the article keep its path above their own.
        above = rows[at - 1][0].path[:-1] if 0 < at < len(rows) and rng.random() < 0.5 else (("html", ()), ("body", ()))
        put = []
        for _ in range(int(rng.integers(1, 6))):
            linked = 1.0 if short and rng.random() < 0.8 else 0.0
            put.append((Block(text(short), (*above, holder, (leaf, ())), linked), 0.0))
        rows[at:at] = put
    return [b for b, _ in rows], np.array([label for _, label in rows])


def train(pages: list[list[Block]], seed: int = 5) -> Labeller:
    """A labeller from pages with landmarks, by Adam on cross entropy."""
    rng = np.random.default_rng(seed)
    net = Labeller(seed)
    labelled = [(p, landmark_labels(p)) for p in pages if p]
    labelled = [(p, y) for p, y in labelled if y.any()]
    if not labelled:
        labelled = _plain_pages(rng)
    texts = [b.text for p, y in labelled for b, label in zip(p, y, strict=True) if label]
    rows = [(p, y) for p, y in labelled]
    for _ in range(COPIES):
        rows += [_varied(p, y, texts, rng) for p, y in labelled]
    xs = features([p for p, _ in rows])
    m = [np.zeros_like(w) for w in net.weights]
    v = [np.zeros_like(w) for w in net.weights]
    step, size, longest = 0, 32, 64
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        for low in range(0, len(order), size):
            cuts = []
            for i in order[low:low + size]:
                at = int(rng.integers(0, max(1, len(xs[i]) - longest + 1)))
                cuts.append((xs[i][at:at + longest], rows[i][1][at:at + longest]))
            x, lengths = _padded([c for c, _ in cuts])
            y = np.zeros(x.shape[:2], np.float32)
            for own, (_, labels) in zip(y, cuts, strict=True):
                own[:len(labels)] = labels
            step += 1
            rate = 0.02 * (1 - epoch / EPOCHS)
            for w, g, a, b in zip(net.weights, net.gradients(x, lengths, y), m, v, strict=True):
                g = np.clip(g, -1, 1)
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return net


def _plain_pages(rng: np.random.Generator) -> list[tuple[list[Block], np.ndarray]]:
    """Pages for a table that has none with landmarks: an article between a menu and a footer."""
    def words(n: int) -> str:
        return " ".join("w%d" % k for k in rng.integers(0, 5000, n)) + "."

    out = []
    for _ in range(100):
        body = (("html", ()), ("body", ()))
        page = [Block(words(2), (*body, ("nav", ()), ("ul", ()), ("li", ())), 1.0) for _ in range(5)]
        page += [Block(words(int(rng.integers(8, 80))), (*body, ("article", ()), ("p", ())), 0.0)
                 for _ in range(int(rng.integers(2, 12)))]
        page.append(Block(words(6), (*body, ("footer", ())), 0.0))
        out.append((page, landmark_labels(page)))
    return out


def main_texts(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html",
    train_pages: int = TRAIN_PAGES, train_chars: int = TRAIN_CHARS,
) -> DataFrame:
    """page_id, url, text (main text) and n_chars of every page."""
    pages = pages.select(
        F.col(id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    # Hashes choose the pages, so that no task sends whole pages but those chosen: at most
    # train_pages * train_chars characters come to the driver.
    short = pages.filter(F.length("html").between(1, train_chars)).select(F.xxhash64("page_id").alias("key"), "html")
    chosen = short.select("key").distinct().orderBy("key").limit(train_pages)
    sample = short.join(F.broadcast(chosen), "key").groupBy("key").agg(F.min("html").alias("html")).orderBy("key").collect()
    net = pages.sparkSession.sparkContext.broadcast(train([blocks(r["html"]) for r in sample]))

    def work(batch: pa.RecordBatch) -> dict:
        texts: list[str] = []
        for low in range(0, batch.num_rows, 256):
            part = batch["html"].slice(low, 256).to_pylist()
            texts += net.value.main_text([blocks(h or "") for h in part])
        return {"page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string()),
                "n_chars": np.array([len(t) for t in texts], np.int64)}

    kind = dict(pages.dtypes)["page_id"]
    return map_batches(pages, work, f"page_id {kind}, url string, text string, n_chars long")
