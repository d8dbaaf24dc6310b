"""Periodic runs of words by maximal-pair enumeration.

A run is a stretch of words with smallest period q that no neighbouring word
extends.  Shifted by its period, it is a pair of equal passages that neither the
word before nor the word after extends: a maximal pair at distance q.  The tree
of LCP intervals is walked bottom-up; every node keeps the places of its passage
in one list per left word, and joining two children finds the pairs of places
with different left words whose distance fits the passage's length.  These are
the runs: nothing is extended afterwards.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larch.llm.common import text_or_empty

LEAST_LENGTH = 24
LEAST_EXPONENT = 3
#: Bytes of text searched at a time (a longer text is searched alone).
SLICE_BYTES = 4_000_000
#: Left words of a node beyond which all its places are kept in one list as well.
MANY_CLASSES = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
RUNS_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


def least_passage(length: int, exponent: int) -> int:
    """Length of the shortest passage that a run of at least ``length`` words and
    ``exponent`` periods repeats at the distance of its period."""
    return min(max(length - q, (exponent - 1) * q) for q in range(1, length + 1))


def _repeating(words: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Flags of documents in which ``size`` words in a row may occur twice: equal
    passages have equal hashes, so a document without a flag has none."""
    with np.errstate(over="ignore"):
        mixed = (words.astype(np.uint64) + np.uint64(1)) * _MIX
        mixed = (mixed ^ mixed >> np.uint64(29)) * _MIX
        width = 1
        while width < size:
            step = min(width, size - width)
            mixed = mixed[:-step] * _MIX + (mixed[step:] ^ mixed[step:] >> np.uint64(32))
            width += step
        place = np.flatnonzero(doc[:len(mixed)] == doc[size - 1:size - 1 + len(mixed)])
        keys = (mixed[place] + doc[place].astype(np.uint64)) * _MIX
    bits = max(16, int(4 * len(keys)).bit_length())
    slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
    twice = np.bincount(slot, minlength=1)[slot] > 1
    place, keys = place[twice], keys[twice]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    flags = np.zeros(int(doc[-1]) + 1 if len(doc) else 0, bool)
    flags[doc[place[order][1:][same]]] = True
    return flags


def _suffixes(words: np.ndarray, doc: np.ndarray, least: int):
    """Suffixes of all documents in order, with the number of words each shares
    with the one before (below ``least``: 0).  Documents share nothing."""
    n = len(words)
    end = np.searchsorted(doc, doc, side="right")
    _, rank, sizes = np.unique(doc.astype(np.int64) * (int(words.max()) + 1) + words,
                               return_inverse=True, return_counts=True)
    # A suffix's rank is the place of its group in the order, from 1.
    rank = (np.cumsum(sizes) - sizes + 1)[rank]
    levels = [rank.astype(np.int32)]
    active, step = np.flatnonzero(sizes[np.searchsorted(np.cumsum(sizes), rank)] > 1), 1
    while len(active):
        after = active + step
        follow = np.where(after < end[active], rank[np.minimum(after, n - 1)], 0)
        key = rank[active] * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        at = np.arange(len(active))
        new_group = np.append(True, key[1:] != key[:-1])
        old_first = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), at, 0))
        first = np.maximum.accumulate(np.where(new_group, at, 0))
        rank = rank.copy()
        rank[active] = old + first - old_first
        alone = new_group & np.append(new_group[1:], True)
        active = active[~alone]
        levels.append(rank.astype(np.int32))
        step *= 2
    suffix = np.empty(n, np.int64)
    suffix[rank - 1] = np.arange(n)
    shared = np.zeros(n, np.int64)
    level = min(least.bit_length() - 1, len(levels) - 1)
    near = 1 + np.flatnonzero(levels[level][suffix[1:]] == levels[level][suffix[:-1]])
    a, b = suffix[near - 1], suffix[near]
    length = np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a + length < end[a]) & (b + length < end[b])
        equal = inside & (levels[k][np.minimum(a + length, n - 1)] == levels[k][np.minimum(b + length, n - 1)])
        length += equal.astype(np.int64) << k
    shared[near] = np.where(length >= least, length, 0)
    return suffix, shared


class _Node:
    """The places of one passage: an ordered list for each left word."""

    __slots__ = ("size", "classes", "places")

    def __init__(self, place: int, left: int):
        self.size = 1
        self.classes = {left: [place]}
        self.places = None

    def other(self, place: int, left: int, low: int, high: int) -> int | None:
        """The place nearest to ``place`` in ``low .. high`` that has another left
        word.  Places that near are of one stretch, of whose places only the first has
        another left word than the rest, so that one class at most has any."""
        if self.places is not None:
            lists = [self.places]
        else:
            lists = [places for word, places in self.classes.items() if word != left]
        for places in lists:
            at = bisect_left(places, place)
            if at and places[at - 1] >= low:
                return places[at - 1]
            if at < len(places) and places[at] == place:
                at += 1
            if at < len(places) and places[at] <= high:
                return places[at]
        return None

    def add(self, place: int, left: int) -> None:
        mine = self.classes.setdefault(left, [])
        if mine and mine[-1] < place:
            mine.append(place)
        else:
            insort(mine, place)
        if self.places is not None:
            insort(self.places, place)
        elif len(self.classes) > MANY_CLASSES:
            self.places = sorted(chain.from_iterable(self.classes.values()))
        self.size += 1


def _near(places: list[int], place: int, gap: int, after: bool) -> bool:
    """Whether the class list has a place at most ``gap`` before or after ``place``."""
    at = bisect_left(places, place)
    if after:
        at += at < len(places) and places[at] == place
        return at < len(places) and places[at] - place <= gap
    return at > 0 and place - places[at - 1] <= gap


def _join(a: _Node, b: _Node, length: int, left: list[int], least: int, exponent: int, found: list) -> _Node:
    """Joins two children of the node whose passage has ``length`` words and adds the
    runs among pairs of a place of one and a place of the other."""
    if a.size < b.size:
        a, b = b, a
    gap = length // (exponent - 1)
    alike = len(a.classes) == 1 and a.classes.keys() == b.classes.keys()
    fresh = [(place, word) for word, places in b.classes.items() for place in places]
    pairs = []
    if not alike:
        # Different left words: such a pair cannot be moved to the left.
        for place, word in fresh:
            partner = a.other(place, word, place - gap, place + gap)
            if partner is not None and left[partner] != word:
                pairs.append((min(place, partner), max(place, partner)))
    for place, word in fresh:
        a.add(place, word)
    for first, second in pairs:
        # Two places of the stretch alone: their distance is its smallest period.
        # With more of them near it is a multiple, found with fewer words shared.
        period = second - first
        if length + period >= least and not _near(a.classes[left[second]], second, gap, True) \
                and not _between(a.classes[left[second]], first, second):
            found.append((first, length + period, period))
    return a


def _between(places: list[int], first: int, second: int) -> bool:
    at = bisect_left(places, second)
    return at > 0 and places[at - 1] > first


def _pairs(suffix: list[int], shared: list[int], left: list[int], least: int, exponent: int) -> list:
    """Runs from suffixes in order: the LCP intervals closed bottom-up by a stack."""
    found: list = []
    stack: list[tuple[int, _Node]] = []
    shared = shared + [0]
    for i, place in enumerate(suffix):
        node, length = _Node(place, left[place]), shared[i + 1]
        while stack and stack[-1][0] > length:
            deep, open_node = stack.pop()
            node = _join(open_node, node, deep, left, least, exponent, found)
        if stack and stack[-1][0] == length:
            deep, open_node = stack.pop()
            node = _join(open_node, node, deep, left, least, exponent, found)
        if length:
            stack.append((length, node))
    return found


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = LEAST_LENGTH,
              exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of every run, by start and period, for documents
    whose word numbers follow one another in ``words``."""
    if least < 1 or exponent < 3:
        raise ValueError("runs have at least one word and three periods")
    runs: list[list] = [[] for _ in range(len(sizes))]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    passage = least_passage(least, exponent)
    if len(words) <= passage:
        return runs
    keep = _repeating(words, doc, passage)[doc]
    words, doc = words[keep], doc[keep]
    if not len(words):
        return runs
    first = np.searchsorted(doc, np.arange(len(sizes)))
    suffix, shared = _suffixes(words, doc, passage)
    used = (shared > 0) | np.append(shared[1:] > 0, False)
    # The first word of a document has a left word of its own.
    left = np.append(-1, words[:-1])
    left[np.append(True, doc[1:] != doc[:-1])] = -1
    for start, length, period in _pairs(suffix[used].tolist(), shared[used].tolist(), left.tolist(),
                                        least, exponent):
        own = int(doc[start])
        runs[own].append((start - int(first[own]), length, period))
    for found in runs:
        found.sort(key=lambda run: (run[0], run[2]))
    return runs


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def _slices(texts: list[bytes]):
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_BYTES):
            size += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def with_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST_LENGTH,
              exponent: int = LEAST_EXPONENT, runs_col: str = "runs",
              collapsed_col: str = "collapsed") -> DataFrame:
    """Adds the runs of each text, ``(start, length, period)`` in words by start and
    period, and the text without the words that only repeat: those in any run after
    its first period go, the rest are joined by one space.

    Words are what ASCII white space separates, compared byte by byte.  A run has
    at least ``least`` words and ``exponent`` (three or more) periods.  A null or
    empty text has no runs and collapses to the empty text.  Every row is searched
    on its own and whole, whatever its length; repeated rows get equal results.
    Other columns pass through (the two result columns are replaced); an empty
    table gives an empty table.
    """
    @F.arrow_udf(f"struct<runs:{RUNS_TYPE},collapsed:binary>")
    def searched(texts: pa.Array) -> pa.Array:
        all_runs, all_texts = [], []
        for part in _slices(texts.to_pylist()):
            lists = [text.split() for text in part]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            number: dict[bytes, int] = {}
            words = np.fromiter(map(number.setdefault, chain.from_iterable(lists), count()),
                                np.int64, int(sizes.sum()))
            del number
            found = find_runs(words, sizes, least, exponent)
            all_runs.extend(found)
            all_texts.extend(map(_collapsed, lists, found))
        flat = np.array([run for runs in all_runs for run in runs], np.int64).reshape(-1, 3)
        ends = np.cumsum([0] + [len(runs) for runs in all_runs])
        runs = pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()),
            pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)],
                                       ["start", "length", "period"]))
        return pa.StructArray.from_arrays(
            [runs, pa.array(all_texts, pa.binary())], ["runs", "collapsed"])

    result = "_runs_of_text"
    return (docs.withColumn(result, searched(text_or_empty(text_col).cast("binary")))
            .withColumn(runs_col, F.col(result)["runs"])
            .withColumn(collapsed_col, F.col(result)["collapsed"].cast("string"))
            .drop(result))
