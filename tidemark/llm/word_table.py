"""Byte-level BPE through a table of distinct words, and decoding through the table of pieces.

Texts are split into words where the vocabulary's rule cuts them; no merge crosses a cut, so a word has the
same ids wherever it stands. Tasks number the distinct words of every block of about BLOCK_BYTES of text.
The words of all blocks meet by their own value, where each distinct word is encoded once; its ids go back
to the blocks that hold it, and there take the places of the word's number in every text. What moves is a
word once for each block that holds it, and the packed numbers of the texts; texts stay where they are. A
word as frequent as can be is one row a block, so no word is too hot.

Decoding joins ids with the pieces by id. The pieces are a file's fixed table (PIECES at most), so they are
sent around and joined where the ids are.

`docs` is read twice, once for its words and once for its numbers, and must give the same rows in the same
partitions both times, as a table read from files does.

A null text is an empty one and has no ids. The texts of added tokens are those tokens, as the library reads
them. Very long texts form a block of their own; very long words are merged by a heap. Repeated rows stay
repeated, null ids are ids like any other, and columns that are not kept may have any name. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# Text whose words share one numbering.
BLOCK_BYTES = 48 << 20
# The most pieces a vocabulary may have to be sent around.
PIECES = 1 << 20
# Where this family of vocabularies cuts words.
WORD = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Below these characters all versions of Unicode agree on letters and digits.
_disputed = regex.compile("[\u0530-\U0010ffff]")
# Longer words are merged by a heap.
SHORT = 40
_NEVER = 1 << 62
_word = regex.compile(WORD)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the file: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Vocabulary:
    """The merges and pieces of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        ids: dict[str, int] = model["model"]["vocab"]
        self.bytes = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[ids[a], ids[b]] = rank, ids[a + b]
        self.added = {t["content"]: t["id"] for t in model["added_tokens"]}
        pieces = {i: bytes(letters[c] for c in piece) for piece, i in ids.items()}
        pieces |= {i: piece.encode() for piece, i in self.added.items()}
        if len(pieces) > PIECES:
            raise ValueError(f"{path} has more than {PIECES} pieces")
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]

    def encode(self, word: str) -> list[int]:
        """The ids of one word: the earliest merge first, then the leftmost."""
        if word in self.added:
            return [self.added[word]]
        ids = [self.bytes[b] for b in word.encode("utf-8", "replace")]
        if len(ids) > SHORT:
            return self._encode_long(ids)
        merges = self.merges
        ranks = [merges.get(pair, (_NEVER, 0)) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best[0] == _NEVER:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [best[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = merges.get((ids[i - 1], ids[i]), (_NEVER, 0))
            if i < len(ranks):
                ranks[i] = merges.get((ids[i], ids[i + 1]), (_NEVER, 0))
        return ids

    def _encode_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        agenda = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                found = self.merges.get((ids[i], ids[after[i]]))
                if found:
                    heappush(agenda, (found[0], i, ids[i], ids[after[i]]))

        for i in range(n - 1):
            offer(i)
        while agenda:
            _, i, left, right = heappop(agenda)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = self.merges[left, right][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once a worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


# Splitting.


class Splitter:
    """Words of a text, by the rule and the added tokens of a vocabulary file."""

    def __init__(self, path: str):
        self.added = sorted(vocabulary(path).added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        # Where versions of Unicode differ, the file's own splitter decides.
        self.own = Tokenizer.from_file(path).pre_tokenizer

    def plain(self, text: str) -> list[str]:
        if _disputed.search(text):
            return [text[a:b] for _, (a, b) in self.own.pre_tokenize_str(text)]
        return _word.findall(text)

    def words(self, text: str) -> list[str]:
        if self.cut is None or not any(t in text for t in self.added):
            return self.plain(text)
        found: list[str] = []
        for n, part in enumerate(self.cut.split(text)):
            found.extend([part] if n % 2 else self.plain(part))
        return found


# A space that no cut stands before, whatever follows: before white space (a superset of what any version
# of Unicode calls so) or at the end.
_UNCUT = r" ([\s\x0b\x1c-\x1f\x{85}\x{a0}\x{180e}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)"


class Block:
    """The distinct words of neighbouring texts, in `order`, and the texts as their numbers.

    A cut of the rule stands before every single space with a non-space behind it, so such texts fall into
    the parts between spaces, and each distinct part is split once a block. Others are split as a whole.
    """

    def __init__(self, splitter: Splitter, texts: pa.ChunkedArray):
        texts = pc.fill_null(texts.combine_chunks().cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, _UNCUT)
        for token in splitter.added:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        self.odd = odd.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
        self.ends = lists.offsets.to_numpy()
        encoded = lists.values.dictionary_encode()
        self.parts = encoded.indices.to_numpy().astype(np.int64)
        heads = np.zeros(len(self.parts), bool)
        heads[self.ends[:-1]] = True
        # A part at the beginning of a text has no space before it, so it has a number of its own.
        n = len(encoded.dictionary)
        used = np.zeros(2 * n, bool)
        self.parts[heads] += n
        used[self.parts] = True
        known: dict[str, int] = {}
        number = known.setdefault
        self.lists: list[list[int]] = [[]] * (2 * n)
        every = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        agreed = not _disputed.search("".join(every))
        for i in np.flatnonzero(used).tolist():
            part = " " + every[i] if i < n else every[i - n]
            if agreed and every[i % n].isalpha():
                self.lists[i] = [number(part, len(known))]
            else:
                self.lists[i] = [number(w, len(known)) for w in splitter.plain(part)]
        self.whole = [[known.setdefault(w, len(known)) for w in splitter.words(text)]
                      for text in texts.filter(odd).to_pylist()]
        self.order = sorted(known)
        self.place = np.empty(len(known), np.int32)
        self.place[[known[w] for w in self.order]] = np.arange(len(known), dtype=np.int32)

    def numbers(self) -> Iterator[np.ndarray]:
        """The word numbers of each text: places in the sorted distinct words."""
        sizes = np.array([len(x) for x in self.lists], np.int64)
        flat = self.place[np.fromiter((w for x in self.lists for w in x), np.int64, int(sizes.sum()))]
        begins = np.concatenate([[0], np.cumsum(sizes)])
        whole, n = iter(self.whole), 0
        for odd in self.odd:
            if odd:
                yield self.place[np.array(next(whole), np.int64)]
            else:
                yield gathered(flat, begins, self.parts[self.ends[n]:self.ends[n + 1]])
                n += 1


def gathered(flat: np.ndarray, begins: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The chosen lists of a ragged array, one after the other."""
    sizes = begins[which + 1] - begins[which]
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(begins[which] - ends + sizes, sizes) + np.arange(ends[-1])]


@lru_cache(maxsize=1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(numbers: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed: high bytes are mostly equal."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return _codec()[0].compress(planes.tobytes())


def unpacked(data: bytes | pa.Buffer) -> np.ndarray:
    planes = np.frombuffer(_codec()[1].decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def _blocks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[int, Block, list[pa.RecordBatch]]]:
    """Blocks with their ids and the rows they come from; ids hold the partition and a number in it."""
    splitter, rows, size, id_ = Splitter(path), [], 0, None

    def block() -> Block:
        return Block(splitter, pa.chunked_array([r["text"] for r in rows]))

    for batch in batches:
        id_ = (batch["part"][0].as_py() << 20) if id_ is None and len(batch) else id_
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
        low = 0
        while low < len(batch):
            high = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + BLOCK_BYTES - size)) + 1
            rows.append(batch.slice(low, high - low))
            size += int(ends[min(high, len(ends)) - 1] - (ends[low - 1] if low else 0))
            low = high
            if size >= BLOCK_BYTES:
                yield id_, block(), rows
                rows, size, id_ = [], 0, id_ + 1
    if rows:
        yield id_, block(), rows


# Rows that leave a task together.
_ROWS = 4096
# The place of a word in its block is the lower half of a number, its block the upper.
_HALF = 32


def _words(docs: DataFrame, path: str) -> DataFrame:
    """`word`, `at`: each distinct word of each block with its block and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id_, block, _ in _blocks(batches, path):
            for low in range(0, len(block.order), 1 << 16):
                some = block.order[low:low + (1 << 16)]
                at = np.arange(low, low + len(some), dtype=np.int64) + (id_ << _HALF)
                yield pa.RecordBatch.from_pydict({
                    "word": pa.array([w.encode("utf-8", "surrogatepass") for w in some], pa.binary()),
                    "at": pa.array(at)})

    return docs.select("part", "text").mapInArrow(run, "word binary, at long")


# Words of all blocks that a task encodes before it sends them, packed by block.
_TOGETHER = 1 << 20


def _encoded(words: DataFrame, path: str) -> DataFrame:
    """`block`, `words` for the words of every block: numbers, sizes and ids, packed, some thousands a row. A
    distinct word is encoded once: its rows follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = vocabulary(path).encode, (None, [])
        at: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        n = 0

        def send() -> pa.RecordBatch:
            places, size, flat = np.concatenate(at), np.concatenate(sizes), np.concatenate(ids)
            begins = np.concatenate([[0], np.cumsum(size)])
            order = np.argsort(places, kind="stable")
            blocks = places[order] >> _HALF
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(order)]
            made = []
            for low, high in zip(edges, edges[1:]):
                own = order[low:high]
                numbers = places[own] & ((1 << _HALF) - 1)
                made.append((int(blocks[low]), _joined(
                    np.diff(numbers, prepend=0), size[own], gathered(flat, begins, own))))
            for used in (at, sizes, ids):
                used.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.binary())],
                names=["block", "words"])

        for batch in batches:
            column = batch["word"].dictionary_encode()
            own = []
            for word in column.dictionary.to_pylist():
                if word != last[0]:
                    last = word, encode(word.decode("utf-8", "surrogatepass"))
                own.append(last[1])
            size = np.array([len(x) for x in own], np.int64)
            begins = np.concatenate([[0], np.cumsum(size)])
            which = column.indices.to_numpy().astype(np.int64)
            at.append(batch["at"].to_numpy())
            sizes.append(size[which])
            ids.append(gathered(np.array([i for x in own for i in x], np.int64), begins, which))
            n += len(batch)
            if n >= _TOGETHER:
                yield send()
                n = 0
        if n:
            yield send()

    together = words.repartition("word").sortWithinPartitions("word")
    return together.mapInArrow(run, "block long, words binary")


def _joined(*columns: np.ndarray) -> bytes:
    """Several columns of numbers in one value."""
    parts = [packed(c) for c in columns]
    return b"".join([np.array([len(p) for p in parts], "<u4").tobytes(), *parts])


def _parted(data: bytes, n: int) -> list[np.ndarray]:
    ends = 4 * n + np.concatenate([[0], np.cumsum(np.frombuffer(data, "<u4", n).astype(np.int64))])
    return [unpacked(data[a:b]) for a, b in zip(ends, ends[1:])]


def _numbered(docs: DataFrame, kept: str, path: str) -> DataFrame:
    """`block`, `kept`, `numbers` of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id_, block, rows in _blocks(batches, path):
            made = [packed(x) for x in block.numbers()]
            at = 0
            for batch in rows:
                own = made[at:at + len(batch)]
                at += len(batch)
                for low in range(0, len(own), _ROWS):
                    some = own[low:low + _ROWS]
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([id_] * len(some), pa.int64()),
                        "kept": batch["kept"].slice(low, len(some)), "numbers": pa.array(some, pa.binary())})

    return docs.mapInArrow(run, f"block long, kept {kept}, numbers binary")


# What is made of a batch: the kept columns, where each text's ids begin, and all ids.
Finish = Callable[[pa.StructArray, np.ndarray, np.ndarray], dict[str, object]]


def encoded_rows(docs: DataFrame, keep: Sequence[str], finish: Finish, schema: str, path: str) -> DataFrame:
    """Encode `text` and give each batch of rows to `finish`, which returns the new columns by name."""
    docs = docs.select(
        F.spark_partition_id().cast("long").alias("part"), F.struct(*keep).alias("kept"), "text")
    kept = docs.schema["kept"].dataType.simpleString()
    table = _encoded(_words(docs, path), path)
    texts = _numbered(docs, kept, path)
    names = [*keep, *(part.strip().split(" ")[0] for part in schema.split(","))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packs, flat, begins = None, [], None, None
        for batch in batches:
            blocks = batch["block"].to_numpy()
            edges = np.flatnonzero(np.diff(blocks)) + 1
            for low, high in zip([0, *edges], [*edges, len(blocks)], strict=True):
                if blocks[low] != now:
                    now, packs, flat = blocks[low], [], None
                part = batch.slice(low, high - low)
                n = len(part) - part["words"].null_count  # the words of a block come before its texts
                packs += [w.as_py() for w in part["words"].slice(0, n)]
                if n == len(part):
                    continue
                if flat is None:
                    flat, begins = _table(packs)
                rest = part.slice(n)
                for at in range(0, len(rest), 256):
                    some = rest.slice(at, 256)
                    own = [unpacked(x.as_buffer()) for x in some["numbers"]]
                    which = np.concatenate(own).astype(np.int64)
                    found = gathered(flat, begins, which)
                    sizes = np.concatenate([[0], np.cumsum(begins[which + 1] - begins[which])])
                    ends = sizes[np.concatenate([[0], np.cumsum([len(x) for x in own])])]
                    yield _row_batch(some["kept"], keep, names, finish(some["kept"], ends, found))

    nothing = F.lit(None).cast("binary")
    everything = texts.withColumn("words", nothing).unionByName(table.select(
        "block", F.lit(None).cast(kept).alias("kept"), nothing.alias("numbers"), "words"))
    order = F.col("numbers").isNotNull()
    types = {f.name: f.dataType.simpleString() for f in docs.schema["kept"].dataType.fields}
    result = ", ".join([*(f"`{c}` {types[c]}" for c in keep), schema])
    return everything.repartition("block").sortWithinPartitions("block", order).mapInArrow(run, result)


def _table(packs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a block's words in the order of their numbers, as a ragged array."""
    numbers, sizes, ids = [], [], []
    for data in packs:
        steps, size, own = _parted(data, 3)
        numbers.append(np.cumsum(steps.astype(np.int64)))
        sizes.append(size)
        ids.append(own)
    if not packs:
        return np.empty(0, "<u4"), np.zeros(1, np.int64)
    order = np.argsort(np.concatenate(numbers))
    size = np.concatenate(sizes).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(size)])
    return gathered(np.concatenate(ids), begins, order), np.concatenate([[0], np.cumsum(size[order])])


def _row_batch(kept: pa.StructArray, keep: Sequence[str], names: list[str], made: dict[str, object]) -> pa.RecordBatch:
    columns = [kept.field(c) for c in keep] + [made[c] for c in names[len(keep):]]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def encode_documents(docs: DataFrame, keep: Sequence[str] = ("doc_id",), path: str = VOCABULARY) -> DataFrame:
    """The kept columns and the `ids` of every row's `text`."""

    def lists(kept: pa.StructArray, ends: np.ndarray, ids: np.ndarray) -> dict[str, object]:
        return {"ids": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))}

    return encoded_rows(docs, keep, lists, "ids array<int>", path)


class Decoder:
    """The pieces as one table by id, which ids are joined with."""

    def __init__(self, path: str):
        pieces = vocabulary(path).pieces
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.begins = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

    def texts(self, ends: np.ndarray, ids: np.ndarray) -> list[str]:
        """The text of each row, whose ids end where `ends` says; unknown ids are passed over."""
        known = ids < len(self.begins) - 1
        if not known.all():
            ends = np.concatenate([[0], np.cumsum(known)])[ends]
            ids = ids[known]
        ids = ids.astype(np.int64)
        data = gathered(self.flat, self.begins, ids).tobytes()
        sizes = np.concatenate([[0], np.cumsum(self.begins[ids + 1] - self.begins[ids])])[ends]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(sizes, sizes[1:])]


def decode_documents(rows: DataFrame, keep: Sequence[str] = ("doc_id",), path: str = VOCABULARY) -> DataFrame:
    """The kept columns and the `text` of every row's `ids`; null ids are no text, so an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for batch in batches:
            ids = pc.fill_null(batch["_ids"], pa.scalar([], batch["_ids"].type))
            ends = ids.offsets.to_numpy()
            values = pc.fill_null(ids.values, -1).to_numpy()[ends[0]:ends[-1]]
            texts = decoder.texts(ends - ends[0], values.astype(np.int64).view(np.uint64))
            columns = [batch[c] for c in keep] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text"])

    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "text string"])
    return rows.select(*keep, F.col("ids").alias("_ids")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """`doc_id` with the number of ids, and hashes of the ids and of the text decoded from them."""
    made: dict[str, Decoder] = {}

    def digests(kept: pa.StructArray, ends: np.ndarray, ids: np.ndarray) -> dict[str, object]:
        if not made:
            made[path] = Decoder(path)
        data = np.ascontiguousarray(ids, "<u4").tobytes()
        return {
            "n_tokens": np.diff(ends).astype(np.int64),
            "ids_sha256": [hashlib.sha256(data[4 * a:4 * b]).hexdigest() for a, b in zip(ends, ends[1:])],
            "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in made[path].texts(ends, ids)]}

    return encoded_rows(docs, ("doc_id",), digests, "n_tokens long, ids_sha256 string, decoded_sha256 string", path)
