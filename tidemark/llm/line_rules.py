"""Quality rules: base counts of a text, and removal of lines that many documents of a host share.

Lines are normalised (A-Z to a-z, digits to 0, white space to one space, trimmed) and hashed. For each
host the distinct documents that hold a line are counted; copies of one text are one document, so a
document is not turned away for having been copied. A line is frequent in a host if at least
`min_documents` of its documents and `max_share` of them hold it. Frequent lines go, and a document that
keeps less than `min_left` of its words, or fewer than `min_words` of them, is depleted.

Every row is judged by itself: repeated ids keep their rows. A null text has no words and fails; a null
host is a host of its own. Lines without a word count nowhere. Other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import Words, buffers, map_batches, word_chunks

MIN_DOCUMENTS = 10
MAX_SHARE = 0.01
MIN_LEFT = 0.5
MIN_WORDS = 10
REPEAT_PERCENT = 20
REPEAT_WINDOW = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
# What becomes of a byte in a normalised line.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))


def _repeated_words(hashes: np.ndarray, n_words: int) -> int:
    """Words inside windows that occur at least twice in the text."""
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(hashes, twice))
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + REPEAT_WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def _lines(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.split()]


def _counts(words: Words, out: dict[str, np.ndarray]) -> None:
    rows = slice(words.rows.start, words.rows.stop)
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    chars = np.concatenate([[0], np.cumsum(points[words.ends] - points[words.starts])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[words.data])])
    out["n_words"][rows] = words.counts
    out["word_chars"][rows] = np.diff(chars[words.first])
    out["n_symbols"][rows] = np.diff(symbols[words.row_at])
    made, first = words.windows(REPEAT_WINDOW)
    for i, row in enumerate(words.rows):
        if first[i + 1] - first[i] > 1:
            out["n_repeat_words"][row] = _repeated_words(
                made[first[i]:first[i + 1]], int(words.first[i + 1] - words.first[i]))


def _base(batch: pa.RecordBatch) -> dict:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "text_key")
    out = {name: np.zeros(batch.num_rows, np.int64) for name in names}
    for words in word_chunks(batch["text"]):
        _counts(words, out)
    data, at = buffers(batch["text"])
    for row in range(batch.num_rows):
        text = data[at[row]:at[row + 1]].tobytes()
        lines = _lines(text)
        out["n_dup_lines"][row] = len(lines) - len(set(lines))
        out["text_key"][row] = np.uint64(xxhash.xxh3_64_intdigest(text)).astype(np.int64)
    return out | {"doc_id": batch["doc_id"], "host": batch["host"]}


def _line_rows(batch: pa.RecordBatch) -> dict:
    """One row for each normalised line of a document, with the words of all its occurrences."""
    host, keys, lines, sizes = [], [], [], []
    data, at = buffers(batch["text"])
    for row, name in enumerate(batch["host"].to_pylist()):
        text = data[at[row]:at[row + 1]].tobytes()
        found: dict[int, int] = {}
        for line in text.translate(_NORMAL).split(b"\n"):
            words = line.split()
            if words:
                key = xxhash.xxh3_64_intdigest(b" ".join(words))
                found[key] = found.get(key, 0) + len(words)
        host += [name] * len(found)
        keys += [xxhash.xxh3_64_intdigest(text)] * len(found)
        lines += found.keys()
        sizes += found.values()
    return {"host": pa.array(host, pa.string()), "text_key": np.array(keys, np.uint64).view(np.int64),
            "line": np.array(lines, np.uint64).view(np.int64), "words": np.array(sizes, np.int64)}


def line_rules(
    docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source",
    min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row for each row of `docs`: its id, the base counts, `base_failed`, `words_left` (outside
    frequent lines) and `kept`."""
    docs = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("host"))
    base = map_batches(docs, _base, (
        "doc_id long, host string, text_key long, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long"))
    gone = removed_words(docs, min_documents, max_share)
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    failed = (F.col("n_words") < 10) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (
        base.join(gone, ["host", "text_key"], "left")
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                failed.alias("base_failed"), left.alias("words_left"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("words_left") >= min_words)
                    & (F.col("words_left") >= min_left * F.col("n_words"))))


def removed_words(docs: DataFrame, min_documents: int, max_share: float) -> DataFrame:
    """How many words of each distinct text of a host (`host`, `text_key`) are in frequent lines."""
    lines = map_batches(
        docs.select("host", "text"), _line_rows, "host string, text_key long, line long, words long")
    # A line of a text once, however many copies of the text the host has.
    lines = lines.groupBy("host", "line", "text_key").agg(F.max("words").alias("words"))
    total = docs.select("host", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")).groupBy("host").agg(
        F.countDistinct("key").alias("documents"))
    frequent = (
        lines.groupBy("host", "line").agg(F.count("*").alias("held"))
        .filter(F.col("held") >= min_documents)
        .join(total, "host").filter(F.col("held") >= max_share * F.col("documents"))
        .select("host", "line"))
    return lines.join(frequent, ["host", "line"]).groupBy("host", "text_key").agg(
        F.sum("words").alias("gone"))


LINE_RULES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
split AS (
  SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
win AS (
  SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM d)),
again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT rid, count(DISTINCT i + j) AS n_repeat_words
  FROM again, (SELECT unnest(range(0, 5)) AS j) GROUP BY rid),
normal AS (
  SELECT rid, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789',
           'abcdefghijklmnopqrstuvwxyz0000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM split),
held AS (
  SELECT source, line, count(DISTINCT text) AS held
  FROM normal JOIN d USING (rid) WHERE line <> '' GROUP BY source, line),
hosts AS (SELECT source, count(DISTINCT text) AS documents FROM d GROUP BY source),
frequent AS (
  SELECT held.source, line FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source
  WHERE held >= 10 AND held >= 0.01 * documents),
gone AS (
  SELECT rid, sum(n) AS gone
  FROM normal JOIN d USING (rid) JOIN frequent
    ON frequent.line = normal.line AND frequent.source IS NOT DISTINCT FROM d.source
  GROUP BY rid),
counts AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         (len(words) - coalesce(gone, 0))::BIGINT AS words_left
  FROM d LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, words_left,
       NOT base_failed AND words_left >= 10 AND words_left >= 0.5 * n_words AS kept
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
"""
