"""Encoding with a merge-type piece vocabulary under seeded merge-dropout, and decoding without loss.

A text is split into units: a run of spaces with the word after it, or a line break; a word's punctuation
is a unit of its own where no piece holds a letter beside punctuation. No merge can cross these cuts.
Spaces are written as the vocabulary's space mark. In each unit neighbouring symbols are merged in the order of an agenda
(best piece first, then leftmost). Each merge taken from the agenda is skipped with probability `dropout`,
drawn anew for every occurrence of a unit by a keyed hash of the seed, the text and the unit's number in
the text; so repeats of a word are segmented in many ways, equal texts alike, and any task gets the same
pieces. What is drawn is how many merges pass until the next one is skipped. `variants`, if given, lets
the draws of a unit take only that many values. A dropout of 0 gives the vocabulary's own segmentation.

Characters outside the vocabulary become byte pieces, and so does the space mark itself where a text
holds it, so decoding gives the text back, byte for byte. A null text has null pieces and stays null; an
empty text has none. Rows keep their repeats; other columns are kept or dropped as each function says.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import map_batches, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
# Segmentations a worker remembers in the newer of two generations, the longest unit it does so for, and
# how many skipped merges they may have. Others are made anew each time.
REMEMBERED = 400_000
LONGEST = 48
MOST_SKIPS = 2

MARK = "▁"
# Stands for a space mark of the text itself; no valid text holds this half of a surrogate pair.
_OWN_MARK = "\udc81"
_UNIT = re.compile(r"▁*[^▁\n]+|▁+|\n")
_PUNCTUATION = r"!-/:-@\[-^`{-~"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_UNIT_FINE = re.compile(rf"▁*[{_LETTERS}]+(?=[{_PUNCTUATION}▁\n]|\Z)|▁*[^▁\n]+|▁+|\n")
_CROSSING = re.compile(rf"[{_LETTERS}][{_PUNCTUATION}]|[{_PUNCTUATION}][{_LETTERS}]")
# Units up to this long keep their agenda in a list, longer ones in a heap.
SHORT = 40
_NEVER = 1 << 30
# Numbers of characters that are no piece begin here.
_OTHER = 1 << 20
# Stands behind the last symbol of a unit; no pair holds it.
_NONE = 1 << 23
# Units whose symbols are merged together.
ROWS = 1 << 14
_MASK = (1 << 64) - 1
_GOLDEN = 0x9E3779B97F4A7C15


class _Characters(dict):
    """The number of each character."""

    def __init__(self, ids: dict[str, int]):
        super().__init__((p, i) for p, i in ids.items() if len(p) == 1)

    def __missing__(self, character: str) -> int:
        return _OTHER + ord(character)


class Pieces:
    """The vocabulary: pieces with their rank in the agenda, byte pieces, and the bytes of each id."""

    def __init__(self, model: bytes):
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = vocabulary.get_piece_size()
        if n > 1 << 16:
            raise ValueError("pieces are packed in 16 bits")
        self.ids: dict[str, int] = {}
        self.ranks: dict[str, int] = {}
        self.bytes: list[int] = [0] * 256
        spelled = []
        for i in range(n):
            piece = vocabulary.id_to_piece(i)
            if vocabulary.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                spelled.append(bytes([value]))
            elif vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_unused(i):
                spelled.append(b"")
            else:
                self.ids[piece] = i
                spelled.append(piece.replace(MARK, " ").encode())
        best_first = sorted(self.ids, key=lambda p: (-vocabulary.get_score(self.ids[p]), self.ids[p]))
        self.ranks = {piece: rank for rank, piece in enumerate(best_first)}
        # Symbols as numbers: a piece is its id, any other character a number beyond all pieces. `pairs` has
        # the rank of what two neighbours merge to.
        self.characters = _Characters(self.ids)
        self.by_rank = [self.ids[p] for p in best_first]
        self.pairs: dict[int, int] = {}
        for piece, rank in self.ranks.items():
            for cut in range(1, len(piece)):
                left, right = self.symbol(piece[:cut]), self.symbol(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
        self.symbols = np.arange(_OTHER, _OTHER + 0x110000, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        self.merged = np.array(self.by_rank, np.int32)
        self._table()
        self.units = _UNIT if any(_CROSSING.search(p) for p in self.ids) else _UNIT_FINE
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)

    def _table(self) -> None:
        """The pairs by their hashes; a pair whose slot is taken lies in the next free one."""
        bits = max(8, (4 * len(self.pairs)).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), np.full((1 << bits) + len(self.pairs), -1, np.int64)
        self.slot_ranks = np.full(len(self.slots), _NEVER, np.int32)
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        for key, slot in zip(keys.tolist(), self._slots_of(keys).tolist(), strict=True):
            while self.slots[slot] >= 0:
                slot += 1
            self.slots[slot], self.slot_ranks[slot] = key, self.pairs[key]

    def _slots_of(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(_GOLDEN) >> self.shift).astype(np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of what each two symbols merge to, or _NEVER."""
        keys = left.astype(np.int64) << 32 | right
        slots = self._slots_of(keys)
        found = self.slots[slots]
        out = np.where(found == keys, self.slot_ranks[slots], np.int32(_NEVER))
        going = np.nonzero((found != keys) & (found >= 0))
        while len(going[0]):
            slots[going] += 1
            found, own = self.slots[slots[going]], keys[going]
            hit = found == own
            out[tuple(g[hit] for g in going)] = self.slot_ranks[slots[going][hit]]
            on = ~hit & (found >= 0)
            going = tuple(g[on] for g in going)
        return out

    def symbol(self, text: str) -> int | None:
        known = self.ids.get(text)
        return known if known is not None else _OTHER + ord(text) if len(text) == 1 else None

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the pieces spell, without the space put before the text."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ends):
            return b""
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.spelled[at].tobytes()[1:]


class Known:
    """What is remembered of a unit: of its own segmentation, and of those that skip merges, how many
    merges the agenda came to and the packed ids."""

    __slots__ = ("ids", "merges", "skipping")

    def __init__(self, merges: int, ids: bytes):
        self.merges, self.ids = merges, ids
        self.skipping: dict[tuple[int, ...], tuple[int, bytes]] = {}


class _Units:
    """Some units, and their symbols before any merge."""

    def __init__(self, units: list[str], pieces: Pieces):
        self.units = units
        self.lengths = np.fromiter(map(len, units), np.int64, len(units))
        self.starts = np.cumsum(self.lengths) - self.lengths
        characters = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.symbols = pieces.symbols[characters]


class Encoder:
    def __init__(self, pieces: Pieces, dropout: float = DROPOUT, variants: int | None = None, seed: int = 1):
        self.pieces, self.seed, self.dropout, self.variants = pieces, seed, dropout, variants
        self.scale = 1 / math.log1p(-dropout) if 0 < dropout < 1 else 0.0
        # A full generation becomes the older one, from which units in use come back.
        self.newer: dict[str, Known] = {}
        self.older: dict[str, Known] = {}
        self.size = 0

    def encode(self, text: str) -> np.ndarray:
        """The piece ids of a text."""
        if not text:
            return np.empty(0, np.uint16)
        if MARK in text:
            text = text.replace(MARK, _OWN_MARK)
        units = self.pieces.units.findall(MARK + text.replace(" ", MARK))
        out = []
        for unit, key, first in zip(units, *self._drawn(text, len(units)), strict=True):
            known = self.newer.get(unit)
            if known is None:
                if len(unit) > LONGEST:
                    out.append(self._segmented(unit, self._skips(key, (first,)))[1])
                    continue
                known = self._remember(unit)
            out.append(known.ids if first >= known.merges else self._skipping(unit, known, key, first))
        return np.frombuffer(b"".join(out), np.uint16)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many texts, one after the other, and where each begins, and the end: the same ids as
        `encode` gives for each.

        Every distinct unit is segmented once. Occurrences that skip a merge are grouped by their unit and the
        first merge skipped, those that skip another one by that as well, and so on; every group is segmented
        once. Units of one length are merged together, and nothing is remembered for other texts.
        """
        units, of_text, counts = self._units(texts)
        keys = np.repeat(self._text_keys(texts), counts)
        places = np.arange(len(of_text)) - np.repeat(np.cumsum(counts) - counts, counts)
        keys = mix(places.astype(np.uint64) * np.uint64(_GOLDEN) + keys)
        if self.variants:
            keys %= np.uint64(self.variants)
        which = of_text.astype(np.int64)  # of the segmentations made, the one of each occurrence
        given = _Units(units, self.pieces)
        unit, skips = np.arange(len(units)), np.empty((len(units), 0), np.int32)
        merges, *first = self._all_segmented(given, unit, skips)
        made = [first]
        if self.dropout > 0 and len(which):
            base, skip, drawn = 0, self._next_skips(keys, 0), 1
            going = np.flatnonzero(skip < merges[which])
            skip = skip[going]
            while len(going):
                pairs, group = np.unique((which[going] - base) << 32 | skip, return_inverse=True)
                was = pairs >> 32
                unit = unit[was]
                skips = np.column_stack([skips[was], (pairs & 0xFFFFFFFF).astype(np.int32)])
                base += len(merges)
                merges, *more = self._all_segmented(given, unit, skips)
                made.append(more)
                which[going] = base + group
                following = skip + 1 + self._next_skips(keys[going], drawn)
                on = following < merges[group]
                going, skip, drawn = going[on], following[on], drawn + 1
        sizes, flat = (np.concatenate(parts) for parts in zip(*made, strict=True))
        begins = np.concatenate([[0], np.cumsum(sizes)])
        own = sizes[which]
        ends = np.concatenate([[0], np.cumsum(own)])
        ids = flat[np.repeat(begins[which] - ends[:-1], own) + np.arange(ends[-1])]
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]

    def _units(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct units of some texts, their numbers text by text, and how many each text has.

        A unit begins at every single space, so each distinct part between spaces is read once; texts with
        other spaces or the mark itself are read as a whole.
        """
        odd = pc.match_substring_regex(texts, rf"^ |  | $|^$|{MARK}")
        lists = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
        encoded = lists.values.dictionary_encode()
        find, known = self.pieces.units.findall, {}
        number = known.setdefault
        parts = [[number(u, len(known)) for u in find(MARK + part)]
                 for part in encoded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        whole = iter([np.array([number(u, len(known)) for u in find(MARK + t.replace(MARK, _OWN_MARK).replace(
            " ", MARK))] if t else [], np.int64) for t in texts.filter(odd).to_pylist()])
        sizes = np.array([len(p) for p in parts], np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.fromiter((u for p in parts for u in p), np.int64, int(begins[-1]))
        which, ends = encoded.indices.to_numpy().astype(np.int64), lists.offsets.to_numpy()
        own = sizes[which]
        at = np.concatenate([[0], np.cumsum(own)])
        every = flat[np.repeat(begins[which] - at[:-1], own) + np.arange(at[-1])]
        edges, n, found = at[ends], 0, []
        for is_odd in odd.to_pylist():
            found.append(next(whole) if is_odd else every[edges[n]:edges[n + 1]])
            n += not is_odd
        counts = np.array([len(f) for f in found], np.int64)
        return list(known), np.concatenate([np.empty(0, np.int64), *found]), counts

    def _text_keys(self, texts: pa.Array) -> np.ndarray:
        """The key that the draws of each text come from."""
        given = (t.replace(MARK, _OWN_MARK) if MARK in t else t for t in texts.to_pylist())
        return np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"), seed=self.seed)
                         for t in given], np.uint64)

    def _next_skips(self, keys: np.ndarray, drawn: int) -> np.ndarray:
        """How many merges pass before the next skipped one, for many keys."""
        step = np.uint64((drawn + 1) * _GOLDEN & _MASK)
        shares = ((mix(keys + step) >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)
        return np.minimum(np.log(shares) * self.scale, _NEVER).astype(np.int64)

    def _all_segmented(
        self, given: _Units, unit: np.ndarray, skips: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of many units, each with the merges that it skips: how many merges the agenda came to, how many ids
        there are, and all ids one after the other. The same as `_segmented` gives for each."""
        lengths = given.lengths[unit]
        merges, sizes = np.zeros(len(unit), np.int64), np.zeros(len(unit), np.int64)
        own: dict[int, bytes] = {}
        parts = []
        order = np.argsort(lengths, kind="stable")
        cuts = np.searchsorted(lengths[order], np.arange(SHORT + 2))
        for length in range(1, SHORT + 1):
            for low in range(cuts[length], cuts[length + 1], ROWS):
                rows = order[low:min(low + ROWS, cuts[length + 1])]
                symbols = given.symbols[given.starts[unit[rows]][:, None] + np.arange(length)]
                symbols, merges[rows] = self._merged_rows(symbols, skips[rows])
                sizes[rows] = (symbols < _NONE).sum(1)
                for i in np.flatnonzero(((symbols >= _OTHER) & (symbols < _NONE)).any(1)).tolist():
                    own[int(rows[i])] = self._ids(symbols[i, :sizes[rows[i]]].tolist())
                parts.append((rows, symbols))
        for i in order[cuts[SHORT + 1]:].tolist():
            merges[i], own[i] = self._segmented(given.units[unit[i]], skips[i].tolist())
        for i, ids in own.items():
            sizes[i] = len(ids) // 2
        begins = np.cumsum(sizes) - sizes
        flat = np.zeros(int(sizes.sum()), np.uint16)
        for rows, symbols in parts:
            whole = (symbols < _OTHER) | (symbols == _NONE)
            plain = whole.all(1)
            rows, symbols = rows[plain], symbols[plain]
            held = symbols < _NONE
            flat[(begins[rows][:, None] + np.arange(symbols.shape[1]))[held]] = symbols[held]
        for i, ids in own.items():
            flat[begins[i]:begins[i] + sizes[i]] = np.frombuffer(ids, np.uint16)
        return merges, sizes, flat

    def _merged_rows(self, symbols: np.ndarray, skips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`_merged` for many units of one length: a row of symbols each, filled up with _NONE, and the merges."""
        n, length = symbols.shape
        ranks_of, merged = self.pieces.ranks_of, self.pieces.merged
        out, merges = np.full((n, length), _NONE, np.int32), np.zeros(n, np.int64)
        skips = np.column_stack([skips, np.full(n, -1, np.int32)])
        rows, passed, drawn = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        symbols = np.column_stack([symbols, np.full(n, _NONE, np.int32)])
        agenda = ranks_of(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            every = np.arange(len(rows))
            i = agenda.argmin(1)
            best = agenda[every, i]
            on = best < _NEVER
            if not on.all():
                done = ~on
                out[rows[done], :symbols.shape[1] - 1] = symbols[done, :-1]
                merges[rows[done]] = passed[done]
                rows, passed, drawn, symbols, agenda, i, best = (
                    x[on] for x in (rows, passed, drawn, symbols, agenda, i, best))
                every = np.arange(len(rows))
                if not len(rows):
                    break
            skipped = skips[rows, drawn] == passed
            passed += 1
            drawn += skipped
            going = np.flatnonzero(~skipped)
            agenda[every[skipped], i[skipped]] = _NEVER
            whole = len(going) == len(rows)
            s, a, at = (symbols, agenda, i) if whole else (symbols[going], agenda[going], i[going])
            each = np.arange(len(going))
            piece = merged[best if whole else best[going]]
            # What lies behind the merged symbols moves one place to the left.
            s[each, at] = piece
            behind = np.arange(s.shape[1] - 1) > at[:, None]
            s[:, :-1] = np.where(behind, s[:, 1:], s[:, :-1])
            a[:, :-1] = np.where(behind[:, :-1] | (np.arange(a.shape[1] - 1) == at[:, None]), a[:, 1:], a[:, :-1])
            s[:, -1], a[:, -1] = _NONE, _NEVER
            a[each, at] = ranks_of(piece, s[each, at + 1])
            inner = np.flatnonzero(at > 0)
            a[inner, at[inner] - 1] = ranks_of(s[inner, at[inner] - 1], piece[inner])
            if whole:
                # All rows have lost a symbol.
                symbols, agenda = s[:, :-1], a[:, :-1]
            else:
                symbols[going], agenda[going] = s, a
        return out, merges

    def _remember(self, unit: str) -> Known:
        if self.size >= REMEMBERED:
            self.older, self.newer, self.size = self.newer, {}, 0
        known = self.newer[unit] = self.older.get(unit) or Known(*self._segmented(unit, ()))
        self.size += 1 + len(known.skipping)
        return known

    def _skipping(self, unit: str, known: Known, key: int, first: int) -> bytes:
        """The ids of an occurrence that skips the merge with the number `first`, and maybe later ones."""
        skips = (first,)
        while len(skips) <= MOST_SKIPS:
            made = known.skipping.get(skips)
            if made is None:
                made = known.skipping[skips] = self._segmented(unit, skips)
                self.size += 1
            following = skips[-1] + 1 + self._passed(key, len(skips))
            if following >= made[0]:
                return made[1]
            skips += (following,)
        return self._segmented(unit, self._skips(key, skips))[1]

    def _drawn(self, text: str, n: int) -> tuple[Iterable[int], Iterable[int]]:
        """Of each unit of a text the key of its draws, and the number of the first merge skipped."""
        if self.dropout <= 0:
            return repeat(0, n), repeat(_NEVER, n)
        key = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed=self.seed)
        keys = mix(np.arange(n, dtype=np.uint64) * np.uint64(_GOLDEN) + np.uint64(key))
        if self.variants:
            keys %= np.uint64(self.variants)
        shares = ((mix(keys + np.uint64(_GOLDEN)) >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)
        return keys.tolist(), (np.log(shares) * self.scale).astype(np.int64).tolist()

    def _passed(self, key: int, drawn: int) -> int:
        """How many merges pass before the next skipped one, after `drawn` skipped ones."""
        x = key + (drawn + 1) * _GOLDEN & _MASK
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _MASK
        x = (x ^ x >> 27) * 0x94D049BB133111EB & _MASK
        return int(math.log((((x ^ x >> 31) >> 11) + 1) / (1 << 53)) * self.scale)

    def _skips(self, key: int, skips: tuple[int, ...] = ()) -> Iterator[int]:
        """The numbers of the merges skipped: those given and the following ones."""
        yield from skips
        at, drawn = skips[-1] if skips else -1, len(skips)
        while self.dropout > 0:
            at += 1 + self._passed(key, drawn)
            drawn += 1
            yield at

    def unit(self, unit: str, key: int) -> bytes:
        """One unit's ids, packed, with the draws of a key."""
        return self._segmented(unit, self._skips(key))[1]

    def _segmented(self, unit: str, skips: Iterable[int]) -> tuple[int, bytes]:
        """How many merges the agenda came to, skipped ones with them, and the packed ids."""
        skipping = chain(skips, repeat(-1))
        if len(unit) > SHORT:
            symbols, merges = self._merged_long(list(unit), skipping)
            numbers = [self.pieces.symbol(x) for x in symbols]
        else:
            numbers, merges = self._merged(list(map(self.pieces.characters.__getitem__, unit)), skipping)
        return merges, self._ids(numbers)

    def _ids(self, numbers: list[int]) -> bytes:
        """Symbols as packed ids, characters that are no piece as their bytes."""
        if max(numbers) < _OTHER:
            return array("H", numbers).tobytes()
        ids = []
        for number in numbers:
            if number < _OTHER:
                ids.append(number)
            else:
                own = chr(number - _OTHER)
                ids += [self.pieces.bytes[b] for b in (MARK if own == _OWN_MARK else own).encode()]
        return array("H", ids).tobytes()

    def _merged(self, symbols: list[int], skips: Iterator[int]) -> tuple[list[int], int]:
        """The agenda as a list: for each symbol the rank of its merge with the next one."""
        rank, by_rank, merges, skip = self.pieces.pairs.get, self.pieces.by_rank, 0, next(skips)
        agenda = [rank(a << 32 | b, _NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda and (best := min(agenda)) < _NEVER:
            i = agenda.index(best)
            merges += 1
            if merges - 1 == skip:
                agenda[i], skip = _NEVER, next(skips)
                continue
            symbols[i] = piece = by_rank[best]
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = rank(piece << 32 | symbols[i + 1], _NEVER)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] << 32 | piece, _NEVER)
        return symbols, merges

    def _merged_long(self, symbols: list[str], skips: Iterator[int]) -> tuple[list[str], int]:
        """The agenda as a heap of (rank, place, piece); entries that other merges made void are passed."""
        rank, merges, skip, n = self.pieces.ranks.get, 0, next(skips), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(r, i, symbols[i] + symbols[i + 1]) for i in range(n - 1)
                  if (r := rank(symbols[i] + symbols[i + 1])) is not None]
        heapify(agenda)
        while agenda:
            best, i, piece = heappop(agenda)
            j = after[i]
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != piece:
                continue
            merges += 1
            if merges - 1 == skip:
                skip = next(skips)
                continue
            symbols[i], symbols[j] = piece, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(piece + symbols[k])) is not None:
                    heappush(agenda, (r, i, piece + symbols[k]))
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] + piece)) is not None:
                heappush(agenda, (r, h, symbols[h] + piece))
        return [s for s in symbols if s], merges


def _pieces_of(model: str) -> bytes:
    with open(model, "rb") as file:
        return file.read()


# Text that is encoded together.
BLOCK_BYTES = 4 << 20


def by_block(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, object]], schema: str
) -> DataFrame:
    """Run `work` on rows with about BLOCK_BYTES of `text` together; it returns the new columns by name."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def made(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        columns = work(whole)
        return pa.RecordBatch.from_arrays(
            [c if isinstance(c := columns[n], pa.Array) else pa.array(c) for n in names], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for low in range(0, len(batch), 256):
                some = batch.slice(low, 256)
                held.append(some)
                size += pc.sum(pc.binary_length(some["text"])).as_py() or 0
                if size >= BLOCK_BYTES:
                    yield made(held)
                    held, size = [], 0
        if held:
            yield made(held)

    return df.mapInArrow(run, schema)


_encoders: dict[tuple, Encoder] = {}


def _encoder(model: bytes, *options) -> Encoder:
    """The worker's encoder for a vocabulary and its options, with what it remembers."""
    key = xxhash.xxh3_64_intdigest(model), *options
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Pieces(model), *options)
    return _encoders[key]


def _texts(batch: pa.RecordBatch) -> pa.Array:
    return pc.fill_null(batch["text"].cast(pa.large_string()), "")


def encode_documents(
    docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, variants: int | None = None, seed: int = 1,
    id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, pieces (ids, 16 bits each in a row of bytes) and n_pieces of every row. `model` is read
    on the driver and sent to the tasks: the vocabulary file, whatever the input."""
    known = docs.sparkSession.sparkContext.broadcast(_pieces_of(model))

    def work(batch: pa.RecordBatch) -> dict:
        ids, ends = _encoder(known.value, dropout, variants, seed).encode_all(_texts(batch))
        data, nulls = ids.tobytes(), batch["text"].is_null().to_pylist()
        made = [None if null else data[2 * a:2 * b] for null, a, b in zip(nulls, ends, ends[1:])]
        return {"doc_id": batch["doc_id"], "pieces": pa.array(made, pa.binary()),
                "n_pieces": pa.array([None if m is None else len(m) // 2 for m in made], pa.int64())}

    return by_block(
        docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
        work, "doc_id long, pieces binary, n_pieces long")


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text from doc_id and pieces."""
    known = encoded.sparkSession.sparkContext.broadcast(_pieces_of(model))

    def work(batch: pa.RecordBatch) -> dict:
        pieces = _encoder(known.value, 0.0, 1, 0).pieces
        made = [None if p is None else pieces.decode(np.frombuffer(p, np.uint16)).decode()
                for p in batch["pieces"].to_pylist()]
        return {"doc_id": batch["doc_id"], "text": pa.array(made, pa.string())}

    return map_batches(encoded.select("doc_id", "pieces"), work, "doc_id long, text string")


def round_trip(
    docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, variants: int | None = None, seed: int = 1,
    id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Every row encoded and decoded in one task: doc_id, n_chars, n_pieces, the pieces (ids, 16 bits
    each in a row of bytes), their hash and that of the decoded text, and whether the decoded text is
    the text. Null texts count as empty."""
    known = docs.sparkSession.sparkContext.broadcast(_pieces_of(model))

    def work(batch: pa.RecordBatch) -> dict:
        texts, encoder = _texts(batch), _encoder(known.value, dropout, variants, seed)
        ids, ends = encoder.encode_all(texts)
        data = ids.tobytes()
        packed = [data[2 * a:2 * b] for a, b in zip(ends, ends[1:])]
        back = [encoder.pieces.decode(ids[a:b]) for a, b in zip(ends, ends[1:])]
        given = texts.cast(pa.large_binary()).to_pylist()
        return {"doc_id": batch["doc_id"], "n_chars": pc.utf8_length(texts).cast(pa.int64()),
                "n_pieces": pa.array(np.diff(ends).astype(np.int64)), "pieces": pa.array(packed, pa.binary()),
                "pieces_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in back], pa.string()),
                "lossless": pa.array([a == b for a, b in zip(back, given, strict=True)], pa.bool_())}

    return by_block(
        docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
        work, "doc_id long, n_chars long, n_pieces long, pieces binary, pieces_sha256 string, decoded_sha256 string, "
              "lossless boolean")
