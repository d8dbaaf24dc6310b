"""Elias-Fano n-gram trie of one shard (numpy).

Levels, all in one memory-mapped buffer:

* ``successors``: per context word, the words that follow it, as the monotone
  sequence ``context * words + word``; ``first`` points to each context's range;
* ``predecessors``: per context word, the words before it (the longer contexts),
  coded alike;
* ``thirds``: per longer context, its successors as places *within the shorter
  context's successors*: small numbers, made monotone by the context's place.

Every node keeps its smoothed log10 probability, every context its backoff
weight, quantised to two bytes each.
"""

from __future__ import annotations

import mmap

import numpy as np

_SAMPLE = 1024
_BLOCK = 1 << 16


def mapped(arrays: dict[str, np.ndarray], file=None) -> dict[str, np.ndarray]:
    """The arrays as views of one memory map: of ``file`` (open for update), or
    of anonymous memory."""
    spans, size = {}, 0
    for name, a in arrays.items():
        spans[name] = size
        size += -(-a.nbytes // 8) * 8
    if file is not None:
        file.truncate(max(size, 8))
    buffer = mmap.mmap(file.fileno() if file is not None else -1, max(size, 8))
    out = {}
    for name, a in arrays.items():
        view = np.frombuffer(buffer, a.dtype, a.size, spans[name])
        view[:] = a.ravel()
        out[name] = view
    return out


def pack_low(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` low bits of each value; 64 values fill exactly ``bits`` words."""
    groups = -(-len(values) // 64)
    m = np.zeros((groups, 64), np.uint64)
    m.ravel()[:len(values)] = values.astype(np.uint64) & np.uint64((1 << bits) - 1)
    out = np.zeros((groups, bits), np.uint64)
    for j in range(64 if bits else 0):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= m[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= m[:, j] >> np.uint64(64 - shift)
    return out.ravel()


def unpack_low(words: np.ndarray, bits: int, first: int, last: int) -> np.ndarray:
    if not bits:
        return np.zeros(last - first, np.int64)
    g0, g1 = first // 64, -(-last // 64)
    rows = words[g0 * bits:g1 * bits].reshape(-1, bits)
    out = np.empty((len(rows), 64), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, j] = rows[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            out[:, j] |= rows[:, word + 1] << np.uint64(64 - shift)
    out &= np.uint64((1 << bits) - 1)
    return out.ravel()[first - g0 * 64:last - g0 * 64].astype(np.int64)


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary."""

    def __init__(self, values: np.ndarray, universe: int):
        n = self.n = len(values)
        self.bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        ones = (values >> self.bits) + np.arange(n)
        marks = np.zeros(int((int(universe) >> self.bits) + n + 64) // 64 * 64, np.uint8)
        marks[ones] = 1
        self.low = pack_low(values, self.bits)
        self.high = np.packbits(marks, bitorder="little")
        self.place = ones[::_SAMPLE].astype(np.int64)  # of every so-manyth one
        self.sample = values[::_SAMPLE].astype(np.int64)

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.{k}": getattr(self, k) for k in ("low", "high", "place", "sample")}

    def use(self, name: str, views: dict[str, np.ndarray]) -> None:
        for k in ("low", "high", "place", "sample"):
            setattr(self, k, views[f"{name}.{k}"])

    def values(self, first: int, last: int) -> np.ndarray:
        if last <= first:
            return np.zeros(0, np.int64)
        s0, s1 = first // _SAMPLE, -(-last // _SAMPLE)
        bit0 = int(self.place[s0])
        bit1 = int(self.place[s1]) if s1 < len(self.place) else len(self.high) * 8
        raw = np.unpackbits(self.high[bit0 // 8:-(-bit1 // 8)], bitorder="little")
        ones = np.flatnonzero(raw[bit0 % 8:]) + bit0
        ones = ones[first - s0 * _SAMPLE:last - s0 * _SAMPLE]
        return (ones - np.arange(first, last) << self.bits) | unpack_low(
            self.low, self.bits, first, last)

    def find(self, targets: np.ndarray) -> np.ndarray:
        """Place of each target (sorted) in the sequence, or -1: successor
        search in the decoded samples that the targets span."""
        out = np.full(len(targets), -1, np.int64)
        if not self.n:
            return out
        for at in range(0, len(targets), _BLOCK):
            part = targets[at:at + _BLOCK]
            first = max(0, int(np.searchsorted(self.sample, part[0], "left")) - 1) * _SAMPLE
            last = min(self.n, int(np.searchsorted(self.sample, part[-1], "right")) * _SAMPLE)
            if last <= first:
                continue
            found = self.values(first, last)
            i = np.minimum(np.searchsorted(found, part), len(found) - 1)
            out[at:at + _BLOCK] = np.where(found[i] == part, i + first, -1)
        return out


class Quantised:
    """Two bytes per value; a bin stands for the mean of its values.

    One byte is too coarse here: the tokens of a copied text share a few
    probabilities, so a bin's error adds up over the text.
    """

    def __init__(self, values: np.ndarray):
        low = float(values.min()) if len(values) else 0.0
        high = float(values.max()) if len(values) else 0.0
        self.codes = ((values - low) * (65535 / (high - low or 1.0))).astype(np.uint16)
        count = np.bincount(self.codes, minlength=65536)
        total = np.bincount(self.codes, weights=values, minlength=65536)
        self.centres = total / np.maximum(count, 1)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.centres[self.codes[at]]


def discounts(counts: np.ndarray) -> np.ndarray:
    """Absolute discounts of counts one, two and more, from counts of counts."""
    return discounts_of(np.bincount(np.minimum(counts, 5), minlength=6))


def discounts_of(n: np.ndarray) -> np.ndarray:
    """Discounts from the numbers of n-grams seen once, twice, ... (5: or more)."""
    n = n.astype(float)
    out = np.array([0.0, 0.75, 0.75, 0.75])
    if n[1] and n[2]:
        y = n[1] / (n[1] + 2 * n[2])
        for k in (1, 2, 3):
            if n[k] and n[k + 1]:
                out[k] = min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.001)
    return out


def _smoothed(counts: np.ndarray, group: np.ndarray, off: np.ndarray, sums: np.ndarray,
              lower: np.ndarray):
    """Interpolated probabilities of the nodes and the groups' backoff weights.
    ``sums`` has each group's tokens and successors seen once, twice, more often."""
    total = sums[0]
    weight = (off[1:, None] * sums[1:]).sum(axis=0) / np.maximum(total, 1)
    return (counts - off[np.minimum(counts, 3)]) / total[group] + weight[group] * lower, weight


class Trie:
    """Built from sorted distinct training n-grams.

    ``pairs`` are ``context * words + word`` with ``pair_counts``; ``longer`` are
    ``context * words + previous word``; ``triples`` are ``place in longer *
    words + word`` with ``triple_counts``; ``unigram`` has a probability for
    every word.  Discounts ``off2``, ``off3`` and the contexts' sums over all of
    their successors (``sums2`` per context, ``sums3`` per longer one) are given,
    as a shard may hold a part of the successors.
    """

    def __init__(self, contexts: int, words: int, pairs: np.ndarray, pair_counts: np.ndarray,
                 longer: np.ndarray, triples: np.ndarray, triple_counts: np.ndarray,
                 unigram: np.ndarray, off2: np.ndarray, off3: np.ndarray, sums2: np.ndarray,
                 sums3: np.ndarray, file=None):
        self.words, self.contexts = words, contexts
        group = pairs // words
        start = np.searchsorted(group, np.arange(contexts + 1))
        p2, g2 = _smoothed(pair_counts, group, off2, sums2, unigram[pairs % words])
        of, word = np.divmod(triples, words)
        node = np.searchsorted(pairs, longer[of] // words * words + word)
        relative = node - start[longer[of] // words]
        p3, g3 = _smoothed(triple_counts, of, off3, sums3, p2[node])
        self.fan = int(np.diff(start).max(initial=0)) + 1
        self.successors = EliasFano(pairs, contexts * words)
        self.first = EliasFano(start, len(pairs) + 1)
        self.predecessors = EliasFano(longer, contexts * words)
        del group, word, node
        self.thirds = EliasFano(of * self.fan + relative, max(1, len(longer)) * self.fan)
        del of, relative
        log = lambda p: np.log10(np.maximum(p, 1e-30))
        self.p2, self.p3 = Quantised(log(p2)), Quantised(log(p3))
        # A context never seen passes its whole weight on.
        self.g2, self.g3 = Quantised(np.where(g2 > 0, log(g2), 0.0)), Quantised(log(g3))
        levels = ("successors", "first", "predecessors", "thirds")
        parts = {k: v for n in levels for k, v in getattr(self, n).arrays(n).items()}
        for n in ("p2", "p3", "g2", "g3"):
            parts[n] = getattr(self, n).codes
        self.map = mapped(parts, file)
        for n in levels:
            getattr(self, n).use(n, self.map)
        for n in ("p2", "p3", "g2", "g3"):
            getattr(self, n).codes = self.map[n]

    def nbytes(self) -> int:
        return sum(a.nbytes for a in self.map.values())

    def pair_nodes(self, pairs: np.ndarray) -> np.ndarray:
        return self.successors.find(pairs)

    def longer_nodes(self, longer: np.ndarray) -> np.ndarray:
        return self.predecessors.find(longer)

    def triple_nodes(self, longer: np.ndarray, context: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Nodes of triples, sorted by longer context and word, from the nodes
        of their longer contexts and pairs (-1: none)."""
        out = np.full(len(longer), -1, np.int64)
        some = np.flatnonzero((longer >= 0) & (pair >= 0))
        start = self.first.values(0, self.contexts + 1)
        out[some] = self.thirds.find(longer[some] * self.fan + pair[some] - start[context[some]])
        return out

    def log10(self, triple, longer, context, pair, unigram: np.ndarray) -> np.ndarray:
        """log10 probability by the longest known n-gram and backoff weights."""
        take = lambda q, at: q[np.maximum(at, 0)] if len(q.codes) else np.zeros(len(at))
        weight = np.where(longer >= 0, take(self.g3, longer), 0.0)
        lower = np.where(pair >= 0, take(self.p2, pair), self.g2[context] + np.log10(unigram))
        return np.where(triple >= 0, take(self.p3, triple), weight + lower)
