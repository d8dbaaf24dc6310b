"""SentencePiece encoding and decoding by vectorised merge rounds.

The merges of a byte-fallback BPE model run on flat symbol arrays of the distinct words
of a slice of texts: in every round each word finds the least rank among its neighbouring pairs, all its pairs of
that rank merge from the left, and the arrays are compacted until no pair remains.
"""

from __future__ import annotations

import codecs
import heapq
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.llm.common import text_or_empty

SPACE = "▁"
#: Text that is encoded at a time (a longer text is encoded alone).
SLICE_CHARS = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int32(np.iinfo(np.int32).max)
#: Symbols of characters without a piece are numbered from here.
_CHARS = 1 << 24
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = range(1, 7)
UNKNOWN_SURFACE = " ⁇ ".encode()


def _fields(buffer: bytes):
    """``(number, value)`` of every field of one protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = buffer[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(buffer):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        elif tag & 7 == 2:
            size = varint()
            yield tag >> 3, buffer[at:at + size]
            at += size
        else:
            size = 4 if tag & 7 == 5 else 8
            yield tag >> 3, buffer[at:at + size]
            at += size


def _replace_each(error: UnicodeError):
    return "�" * (error.end - error.start), error.end


codecs.register_error("larch.each_byte", _replace_each)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start .. start + size`` of all rows, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Codec:
    """Tables of one model; small (the vocabulary), so tasks get it by broadcast."""

    def __init__(self, model: bytes):
        parts = list(_fields(model))
        pieces, scores, types = [], [], []
        for number, value in parts:
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                types.append(piece.get(3, _NORMAL))
        trainer = dict(_fields(dict(parts).get(2, b"")))
        rules = dict(_fields(dict(parts).get(3, b"")))
        if trainer.get(3, 1) != 2:
            raise ValueError("the model's pieces are not made by merges (BPE)")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only models that keep the text as it is are supported")
        if _USER in types or _UNUSED in types or _BYTE not in types:
            raise ValueError("only models of plain pieces with byte fallback are supported")
        self.dummy_prefix = bool(rules.get(3, 1))
        self._tables(pieces, np.array(scores), types)

    def _tables(self, pieces, scores, types) -> None:
        plain = [i for i, t in enumerate(types) if t == _NORMAL]
        number = {pieces[i]: i for i in plain}
        byte_ids = np.zeros(256, np.int32)
        for i, t in enumerate(types):
            if t == _BYTE:
                byte_ids[int(pieces[i][1:-1], 16)] = i
        self.byte_ids = byte_ids
        chars = {c: number.get(c, _CHARS + ord(c)) for i in plain for c in pieces[i]}
        self.char_symbol = np.arange(_CHARS, _CHARS + 0x110000, dtype=np.int32)
        self.char_symbol[[ord(c) for c in chars]] = list(chars.values())
        self.char_symbol[ord(" ")] = self.char_symbol[ord(SPACE)]
        pairs = {}
        for i in plain:
            p = pieces[i]
            for cut in range(1, len(p)):
                left, right = p[:cut], p[cut:]
                a = chars[left] if cut == 1 else number.get(left)
                b = chars[right] if cut == len(p) - 1 else number.get(right)
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        self._pair_table(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32))
        levels, rank = np.unique(-scores, return_inverse=True)
        self.rank = rank.astype(np.int32)
        uses = np.bincount(rank[plain], minlength=len(levels))
        self.shared = uses > 1  # pieces of equal score
        # Words may only be cut before a space when no piece runs on into one.
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in number)
        surface = [UNKNOWN_SURFACE if t == _UNKNOWN else b"" if t == _CONTROL else
                   bytes([int(p[1:-1], 16)]) if t == _BYTE else p.replace(SPACE, " ").encode()
                   for p, t in zip(pieces, types)]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_size = np.fromiter(map(len, surface), np.int64, len(surface))
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        self.control = np.array([t == _CONTROL for t in types])
        self.leading = np.array([t == _NORMAL and p.startswith(SPACE) for p, t in zip(pieces, types)])
        # All pairs of one rank may merge in one round only if a merge never
        # makes a pair of lesser rank; whether one does shows in the pieces.
        self.one_merge = True
        own = [pieces[i] for i in plain]
        self.one_merge = self._merged(self.char_symbol[_points("".join(own))],
                                      np.array([len(p) for p in own]))[2]

    def _pair_table(self, keys: np.ndarray, pieces: np.ndarray) -> None:
        """An open hash table of the pairs that some piece joins."""
        bits = max(4, int(4 * len(keys)).bit_length())
        self.pair_shift, size = np.uint64(64 - bits), 1 << bits
        self.slot_key, self.slot_piece = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        at = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.slot_key[at] < 0)
            taken, first = np.unique(at[free], return_index=True)
            self.slot_key[taken], self.slot_piece[taken] = keys[free[first]], pieces[free[first]]
            left = self.slot_key[at] != keys
            keys, pieces, at = keys[left], pieces[left], (at[left] + 1) & (size - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> self.pair_shift).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray):
        """Rank and piece of the pairs; no rank where none joins."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slots(keys)
        piece = self.slot_piece[at]
        held = self.slot_key[at]
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        piece[held != keys] = -1
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slot_key) - 1)
            held = self.slot_key[at[open_]]
            found = held == keys[open_]
            piece[open_[found]] = self.slot_piece[at[open_[found]]]
            open_ = open_[~found & (held >= 0)]
        return np.where(piece >= 0, self.rank[piece], _NONE), piece

    def _merged(self, symbols: np.ndarray, sizes: np.ndarray):
        """``(symbols, first symbol of each word, a rank fell)`` after all merges of
        words of ``sizes`` symbols."""
        words = len(sizes)
        word = np.repeat(np.arange(words, dtype=np.int32), sizes)
        done_symbols, done_words, fell = [], [], False
        rank, piece = self._pairs(symbols, np.append(symbols[1:], 0))
        if len(rank):
            rank[np.append(word[1:] != word[:-1], True)] = _NONE
        while len(symbols):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(first, len(word)))
            least = np.minimum.reduceat(rank, first)
            tied = (least != _NONE) & self.shared[np.where(least == _NONE, 0, least)]
            for w in np.flatnonzero(tied).tolist():
                found = self._one_by_one(symbols[first[w]:first[w] + size[w]].tolist())
                done_symbols.append(np.array(found, np.int32))
                done_words.append(np.full(len(found), word[first[w]], np.int32))
            going = np.repeat((least != _NONE) & ~tied, size)
            whole = np.repeat(least == _NONE, size)
            done_symbols.append(symbols[whole])
            done_words.append(word[whole])
            symbols, word, rank, piece = symbols[going], word[going], rank[going], piece[going]
            least = np.repeat(least, size)[going]
            if not len(symbols):
                break
            here = np.flatnonzero(rank == least)
            # Of overlapping pairs every second one merges, from the left.
            fresh = np.append(True, np.diff(here) != 1)
            start = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            here = here[(np.arange(len(here)) - start) % 2 == 0]
            if self.one_merge:
                here = here[np.append(True, word[here][1:] != word[here][:-1])]
            symbols[here] = piece[here]
            keep = np.ones(len(symbols), bool)
            keep[here + 1] = False
            # A merged pair's place, and the pair before it, get a new rank.
            stale = np.zeros(len(symbols), bool)
            stale[here] = True
            stale = stale[keep]
            stale[:-1] |= stale[1:].copy()
            symbols, word, rank, piece, least = (x[keep] for x in (symbols, word, rank, piece, least))
            touched = np.flatnonzero(stale)
            after = np.minimum(touched + 1, len(symbols) - 1)
            new_rank, piece[touched] = self._pairs(symbols[touched], symbols[after])
            new_rank[(after == touched) | (word[after] != word[touched])] = _NONE
            fell |= bool((new_rank < least[touched]).any())
            rank[touched] = new_rank
        if not done_symbols:
            return np.zeros(0, np.int32), np.zeros(words + 1, np.int64), fell
        symbols, order = np.concatenate(done_symbols), np.concatenate(done_words)
        places = np.append(0, np.cumsum(np.bincount(order, minlength=words)))
        # A word is done as a whole: its symbols follow one another here.
        first = np.flatnonzero(np.append(True, order[1:] != order[:-1]))
        size = np.diff(np.append(first, len(order)))
        out = np.empty_like(symbols)
        out[_ranges(places[order[first]], size)] = symbols
        return out, places, fell

    def _one_by_one(self, symbols: list[int]) -> list[int]:
        """The merges of one word in which pieces of equal score compete: the
        leftmost pair of the least rank first, as a queue."""
        after = list(range(1, len(symbols))) + [-1]
        before = list(range(-1, len(symbols) - 1))
        queue: list = []

        def offer(lefts, rights):
            ranks, pieces = self._pairs(np.array([symbols[x] for x in lefts]),
                                        np.array([symbols[y] for y in rights]))
            for x, y, r, p in zip(lefts, rights, ranks.tolist(), pieces.tolist()):
                if r != _NONE:
                    heapq.heappush(queue, (r, x, y, symbols[x], symbols[y], p))

        offer(range(len(symbols) - 1), range(1, len(symbols)))
        while queue:
            _, x, y, a, b, p = heapq.heappop(queue)
            if symbols[x] != a or symbols[y] != b or after[x] != y:
                continue
            symbols[x], symbols[y], after[x] = p, -1, after[y]
            if after[y] >= 0:
                before[after[y]] = x
            near = [(v, w) for v, w in ((before[x], x), (x, after[x])) if v >= 0 and w >= 0]
            if near:
                offer(*zip(*near))
        return [s for s in symbols if s >= 0]

    def _spelled(self, symbols: np.ndarray, first: np.ndarray):
        """Ids of merged symbols; a character without a piece becomes its bytes."""
        odd = np.flatnonzero(symbols >= _CHARS)
        if not len(odd):
            return symbols, first
        spelt = [self.byte_ids[np.frombuffer(chr(c).encode(), np.uint8)]
                 for c in (symbols[odd] - _CHARS).tolist()]
        extra = np.zeros(len(symbols), np.int64)
        extra[odd] = [len(s) - 1 for s in spelt]
        ids = np.repeat(symbols, extra + 1)
        start = np.arange(len(symbols)) + np.cumsum(extra) - extra
        ids[_ranges(start[odd], extra[odd] + 1)] = np.concatenate(spelt)
        return ids, np.append(start, len(ids))[first]

    def _distinct(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """``(places of the distinct words, number of each word)``."""
        place = (np.arange(len(symbols)) - np.repeat(starts, sizes)).astype(np.int32)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(sizes.max()), _MIX))
            terms = (symbols.astype(np.uint64) + np.uint64(1)) * powers[place]
            hashes = np.add.reduceat(terms ^ terms >> np.uint64(31), starts)
        del terms
        order = np.argsort(hashes, kind="stable")
        fresh = np.append(True, hashes[order][1:] != hashes[order][:-1])
        like = np.empty(len(starts), np.int64)
        like[order] = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        # Equal words have equal hashes; words that differ all the same stand alone.
        equal = sizes[like] == sizes
        there = np.repeat(starts[like], sizes) + place
        same = symbols == symbols[np.minimum(there, len(symbols) - 1)]
        equal &= np.logical_and.reduceat(same, starts)
        like = np.where(equal, like, np.arange(len(starts)))
        return np.unique(like, return_inverse=True)

    def _encode_slice(self, texts: list[str]):
        """Ids of all texts one after another, and the number of each."""
        if self.dummy_prefix:
            texts = [" " + text if text else text for text in texts]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        points = _points("".join(texts))
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        symbols = self.char_symbol[points]
        first = np.append(0, np.cumsum(lengths))
        begin = np.zeros(len(points), bool)
        if self.cuts:
            space = symbols == self.char_symbol[ord(SPACE)]
            begin[1:] = space[1:] & ~space[:-1]
        begin[first[:-1][lengths > 0]] = True
        starts = np.flatnonzero(begin)
        sizes = np.diff(np.append(starts, len(points)))
        own, word = self._distinct(symbols, starts, sizes)
        merged, places, _ = self._merged(symbols[_ranges(starts[own], sizes[own])], sizes[own])
        ids, places = self._spelled(merged, places)
        counts = np.diff(places)[word]
        ends = np.append(0, np.cumsum(counts))[np.searchsorted(starts, first)]
        return ids[_ranges(places[word], counts)], np.diff(ends)

    def encode(self, texts: list[str]):
        """``(ids, number of each text's ids)``."""
        ids, counts, at = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= SLICE_CHARS):
                chars += len(texts[end])
                end += 1
            found, sizes = self._encode_slice(texts[at:end])
            ids.append(found)
            counts.append(sizes)
            at = end
        return np.concatenate(ids), np.concatenate(counts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of id lists that follow one another in ``ids``."""
        if len(ids) and not ((ids >= 0) & (ids < len(self.surface_size))).all():
            raise ValueError("an id is not in the vocabulary")
        ends = np.cumsum(counts)
        texts = []
        for start, end in zip((ends - counts).tolist(), ends.tolist()):
            own = ids[start:end]
            shown = np.flatnonzero(~self.control[own])
            strip = int(self.dummy_prefix and len(shown) and self.leading[own[shown[0]]])
            spelt = self.surface[_ranges(self.surface_start[own], self.surface_size[own])].tobytes()
            texts.append(spelt[strip:].decode("utf-8", "larch.each_byte"))
        return texts


def read_codec(path: str) -> Codec:
    """The codec of the model file at ``path``, read by the caller's process."""
    with open(path, "rb") as file:
        return Codec(file.read())


def with_ids(docs: DataFrame, codec: Codec, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """Adds the array of token ids, as the model's library gives them without begin
    and end ids and without sampling.

    A null or empty text has no ids.  A text of any length is encoded whole; bytes
    that are not UTF-8 count as U+FFFD.  Every row is encoded on its own, so repeated
    rows get equal ids and other columns, whatever their names, pass through
    (``out_col`` is replaced).  An empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        ids, counts = shared.value.encode(
            [b.decode("utf-8", "replace") for b in texts.to_pylist()])
        return pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids, pa.int32()))

    return docs.withColumn(out_col, encoded(text_or_empty(text_col).cast("binary")))


def with_decoded(rows: DataFrame, codec: Codec, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the text of an array of ids; a null array has a null text, an empty one
    the empty text.  Control ids have no text, bytes that form no character become
    U+FFFD each; a null or unknown id is an error, as in the model's library."""
    shared = rows.sparkSession.sparkContext.broadcast(codec)

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        texts = shared.value.decode(lists.flatten().to_numpy(zero_copy_only=False), counts)
        # One very long batch may pass what 32-bit offsets address.
        return pa.array(texts, pa.large_string(), mask=lists.is_null().to_numpy(zero_copy_only=False)) \
            .cast(pa.string())

    return rows.withColumn(out_col, decoded(F.col(ids_col).cast("array<int>")))
