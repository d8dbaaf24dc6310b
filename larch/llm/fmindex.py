"""A word-level FM-index of one block of texts: suffix order, wavelet matrix
over the last column, backward search and sampled positions (numpy)."""

from __future__ import annotations

import numpy as np

SAMPLE = 16
BLOCK_BYTES = 1 << 20

_LOWER = np.zeros(256, np.uint8)
_LOWER[0x30:0x3A] = np.arange(0x30, 0x3A)
_LOWER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LOWER[0x80:] = np.arange(0x80, 0x100)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    size = 0

    @classmethod
    def upto(cls, n: int):
        if n > cls.size:
            cls.size = max(n, 4096)
            cls.up, cls.down = _powers(_BASE, cls.size), _powers(_INVERSE, cls.size)
        return cls.up, cls.down


def word_bounds(data: bytes, table: np.ndarray = _LOWER
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes (0 outside words) and the words' starts and ends."""
    low = table[np.frombuffer(data, np.uint8)]
    inside = np.concatenate(([False], low != 0, [False]))
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return low, turns[0::2], turns[1::2]


def word_hashes(data: bytes, table: np.ndarray = _LOWER) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text; ``table`` has the number of
    each byte within words, 0 for bytes between them.

    Blocks are cut between words; within a block all hashes come from one
    running sum of byte times power."""
    out, at = [], 0
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        while end < len(data) and table[data[end]]:
            end += 1
        low, starts, ends = word_bounds(data[at:end], table)
        if len(starts):
            up, down = _Powers.upto(len(low) + 1)
            sums = np.zeros(len(low) + 1, np.uint64)
            np.cumsum(low.astype(np.uint64) * up[:len(low)], out=sums[1:])
            h = (sums[ends] - sums[starts]) * down[starts]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            out.append(h ^ (h >> np.uint64(29)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def suffix_order(rank: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; ``rank`` numbers the first symbols by
    the start of their group, and every suffix meets a unique symbol."""
    n = len(rank)
    rank = rank.astype(np.int64)
    size = np.bincount(rank, minlength=n)
    open_ = np.flatnonzero(size[rank] > 1)
    step = 1
    while len(open_):
        key = rank[open_] * np.int64(n + 1) + rank[np.minimum(open_ + step, n - 1)]
        order = np.argsort(key, kind="stable")
        open_, key = open_[order], key[order]
        group = rank[open_]
        index = np.arange(len(open_))
        old = np.concatenate(([True], group[1:] != group[:-1]))
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.maximum.accumulate(np.where(old, index, 0))
        head = np.maximum.accumulate(np.where(new, index, 0))
        rank[open_] = group + head - first
        alone = new & np.concatenate((new[1:], [True]))
        open_ = open_[~alone]
        step *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class Wavelet:
    """Wavelet matrix: rank of symbols, and the last-to-first walk."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.words, self.counts, self.zeros = bits, [], [], []
        current = symbols.astype(np.int32)
        for level in range(bits - 1, -1, -1):
            bit = (current >> level & 1).astype(bool)
            packed = np.zeros(len(bit) // 64 + 1, "<u8")
            raw = np.packbits(bit, bitorder="little")
            packed.view(np.uint8)[:len(raw)] = raw
            self.words.append(packed)
            self.counts.append(np.concatenate(
                ([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64))))
            self.zeros.append(len(bit) - int(bit.sum()))
            current = np.concatenate((current[~bit], current[bit]))

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        word = self.words[level][i >> 6]
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][i >> 6] + np.bitwise_count(word & mask)

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before position i, plus the start of the
        symbol's run in the bottom order."""
        for level in range(self.bits):
            one = (symbols >> (self.bits - 1 - level) & 1).astype(bool)
            ones = self._ones(level, i)
            i = np.where(one, self.zeros[level] + ones, i - ones)
        return i

    def walk(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each position and its place in the bottom order."""
        symbol = np.zeros(len(i), np.int64)
        for level in range(self.bits):
            one = (self.words[level][i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            ones = self._ones(level, i)
            i = np.where(one, self.zeros[level] + ones, i - ones)
            symbol = symbol * 2 + one
        return symbol, i


class FMIndex:
    """Index of pieces of symbols (0: a word of no phrase).

    Runs of zeros become one separator, and a piece ends with one: phrases never
    hold a zero, so nothing is lost.  Separators are distinct and ordered by
    position, so a suffix is ordered by the words up to the next separator.
    """

    def __init__(self, pieces: list[np.ndarray], alphabet: int):
        whole = np.concatenate([x for p in pieces for x in (p, np.zeros(1, p.dtype))])
        keep = (whole != 0) | np.concatenate(([True], whole[:-1] != 0))
        self.at = np.flatnonzero(keep)  # position in the pieces, separators included
        text = whole[keep].astype(np.int64)
        n, gaps = len(text), text == 0
        count = np.bincount(text, minlength=alphabet + 1)
        start = np.concatenate(([0], np.cumsum(count)))[:-1]
        first = start[text]
        first[gaps] = np.arange(int(gaps.sum()))
        order = suffix_order(first)
        before = np.concatenate((text[-1:], text[:-1]))
        self.start = start
        self.stop = start + count
        last = before[order]
        self.wavelet = Wavelet(last, max(1, int(alphabet).bit_length()))
        self.bottom = self.wavelet.rank(np.arange(alphabet + 1), np.zeros(alphabet + 1, np.int64))
        marked = (order % SAMPLE == 0) | (last == 0)
        self.marked = marked
        self.sampled = order[marked]
        self.nth = np.cumsum(marked) - 1

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the phrases, given as right-aligned symbols."""
        width = phrases.shape[1]
        low, high = self.start[phrases[:, -1]], self.stop[phrases[:, -1]]
        for back in range(1, width):
            live = np.flatnonzero((lengths > back) & (high > low))
            if not len(live):
                break
            symbol = phrases[live, width - 1 - back]
            base = self.start[symbol] - self.bottom[symbol]
            low[live] = base + self.wavelet.rank(symbol, low[live])
            high[live] = base + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the pieces of the suffixes in these rows."""
        out = np.empty(len(rows), np.int64)
        steps = np.zeros(len(rows), np.int64)
        pending = np.arange(len(rows))
        rows = rows.copy()
        while len(pending):
            here = rows[pending]
            found = self.marked[here]
            done = pending[found]
            out[done] = self.sampled[self.nth[rows[done]]] + steps[done]
            pending = pending[~found]
            if len(pending):
                symbol, place = self.wavelet.walk(rows[pending])
                rows[pending] = self.start[symbol] + place - self.bottom[symbol]
                steps[pending] += 1
        return self.at[out]
