"""Language-model scores of texts from an n-gram trie learnt on the corpus.

1. Texts become chunks: distinct word hashes with training counts, and tokens
   as places among them; written once.
2. The words of all chunks meet by hash range, get numbers and counts, and the
   counts return to the chunks.
3. A chunk's distinct n-grams go with their training counts to the shard of their
   context word (the last but one), packed and sorted.  A context word with more
   training tokens than a shard should hold is dealt by the word after it, so a
   shard has whole counts of its pairs and triples; what it cannot know alone,
   the sums over a context's successors, the shards of such a word exchange by
   way of an owner per context.  Counts of counts are summed over all shards.
4. A shard builds the trie of its n-grams and returns the probability of every
   n-gram to the chunk, which sums them per document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larch.llm import fmindex
from larch.llm.common import text_or_empty, written
from larch.llm.ngram_trie import Trie, discounts_of

CHUNK_TOKENS = 1_400_000
VOCABULARY_ROWS = 2_000_000
SHARD_TOKENS = 1_100_000
#: A context word with more training tokens is split by the word after it.
HOT_TOKENS = 280_000
#: A shard unpacks about so many n-grams of chunks at a time.
BATCH_GRAMS = 2_000_000
#: and looks up so many probabilities at a time.
VALUE_GRAMS = 250_000
#: An n-gram's log10 probability travels in whole steps of this size.
SUM_STEP = 1e-5
#: Packed lists up to this size are not worth a compressed frame.
PLAIN_BYTES = 256

_SPACES = np.arange(1, 257, dtype=np.uint16)
_SPACES[0x41:0x5B] += 0x20
_SPACES[[0x20, *range(0x09, 0x0E)]] = 0
_END, _NONE = np.int64(1) << 62, np.int64(-1)


def pack(values: np.ndarray) -> bytes:
    """Numbers in the fewest bytes each; byte planes are compressed where there
    are enough of them.  A small list costs its bytes and one more."""
    if values.dtype.kind == "f":
        kind, wide = 0, np.ascontiguousarray(values, "<f8")
    else:
        top = int(values.max()) if len(values) else 0
        kind = next(s for s in (1, 2, 4, 8) if top < 1 << (8 * s))
        wide = np.ascontiguousarray(values, f"<u{kind}")
    planes = wide.view(np.uint8).reshape(len(wide), wide.itemsize).T.tobytes()
    if len(planes) <= PLAIN_BYTES:
        return bytes([kind | 16]) + planes
    return bytes([kind]) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes) -> np.ndarray:
    kind = data[0] & 15
    planes = data[1:] if data[0] & 16 else zstandard.ZstdDecompressor().decompress(data[1:])
    size = kind or 8
    raw = np.frombuffer(planes, np.uint8).reshape(size, len(planes) // size)
    return np.ascontiguousarray(raw.T).view(f"<u{kind}" if kind else "<f8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def join(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def split(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 4], "little")
        out.append(data[at + 4:at + 4 + n])
        at += 4 + n
    return out


def _by_count(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts, kind="stable")


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


# --- chunks --------------------------------------------------------------------

def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, made = TaskContext.get().partitionId() << 24, 0
    held: list = []

    def chunk() -> pa.RecordBatch:
        ids = pa.concat_arrays([a for a, _, _ in held])
        hashes = [h for _, _, hs in held for h in hs]
        train = np.concatenate([t for _, t, _ in held])
        lengths = np.array([len(h) for h in hashes], np.int64)
        vocabulary, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.bincount(tokens, weights=np.repeat(train, lengths),
                             minlength=len(vocabulary)).astype(np.int64)
        # Frequent words get small numbers, which pack better.
        rank = np.empty(len(counts), np.int64)
        rank[_by_count(counts)] = np.arange(len(counts))
        columns = [pa.array([base + made], pa.int64()),
                   pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                   *[pa.array([b], pa.binary()) for b in (
                       pack(lengths), pack(train.astype(np.int64)), pack_sorted(vocabulary),
                       pack(counts), pack(rank[tokens]))],
                   *[pa.array([int(n)], pa.int64()) for n in (
                       len(vocabulary), train.sum(), lengths[train].sum(), lengths.sum())]]
        return pa.RecordBatch.from_arrays(columns, names=[
            "chunk", "ids", "lengths", "train", "vocabulary", "counts", "tokens",
            "n_vocabulary", "n_train_docs", "n_train_words", "n_words"])

    size = 0
    for batch in batches:
        hashes = [fmindex.word_hashes(t.as_py(), _SPACES) for t in batch.column("text")]
        train = np.array(batch.column("train").to_pylist(), bool)
        at = 0
        while at < len(hashes):
            stop = at
            while stop < len(hashes) and size < CHUNK_TOKENS:
                size += len(hashes[stop]) + 1
                stop += 1
            held.append((batch.column("id").slice(at, stop - at), train[at:stop], hashes[at:stop]))
            at = stop
            if size >= CHUNK_TOKENS:
                yield chunk()
                made, size = made + 1, 0
                held.clear()
    if held and size:
        yield chunk()


# --- vocabulary ------------------------------------------------------------------

def _numbered(chunks: DataFrame) -> DataFrame:
    """``(chunk, part, numbers, counts, distinct)``: numbers (within the part)
    and training counts of the chunk's words, by hash range."""
    total = chunks.agg(F.sum("n_vocabulary")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, total / VOCABULARY_ROWS))))

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, words, counts in zip(batch["chunk"], batch["vocabulary"], batch["counts"]):
                h, c = unpack_sorted(words), unpack(counts)
                cuts = np.searchsorted(h, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) \
                    if bits else np.zeros(0, np.int64)
                parts = [(p, pack_sorted(a), pack(b)) for p, (a, b) in enumerate(
                    zip(np.split(h, cuts), np.split(c, cuts)))]
                yield pd.DataFrame({"part": [p for p, _, _ in parts], "chunk": chunk,
                                    "words": [a for _, a, _ in parts], "counts": [b for _, _, b in parts]})

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack_sorted(w) for w in pdf["words"]]
        words, place = np.unique(np.concatenate(lists), return_inverse=True)
        train = np.concatenate([unpack(c) for c in pdf["counts"]])
        count = np.bincount(place, weights=train, minlength=len(words)).astype(np.int64)
        cuts = np.cumsum([len(x) for x in lists])[:-1]
        out = [(pack_sorted(p), pack(count[p])) for p in np.split(place, cuts)]
        return pd.DataFrame({
            "chunk": pdf["chunk"], "part": pdf["part"], "numbers": [a for a, _ in out],
            "counts": [b for _, b in out],
            "distinct": [int((count > 0).sum())] + [0] * (len(out) - 1)})

    rows = chunks.select("chunk", "vocabulary", "counts").mapInPandas(
        dealt, "part int, chunk long, words binary, counts binary")
    return written(rows.groupBy("part").applyInPandas(
        number, "chunk long, part int, numbers binary, counts binary, distinct long"), "vocabulary")


# --- n-grams ---------------------------------------------------------------------

def _parts(count: np.ndarray, hot: int) -> np.ndarray:
    return np.where(count > hot, -(-count // hot), 1)


def _shard_of(w2: np.ndarray, other: np.ndarray, parts: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a context word (its id) and the other word's bucket among the context's."""
    bucket = (_mix(other) % parts.astype(np.uint64)).astype(np.int64)
    return (_mix(w2 * np.int64(31) + bucket) % np.uint64(shards)).astype(np.int32)


def _tokens(row: pd.Series, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every text's words and then its end (as ``words``), with document and place."""
    lengths = unpack(row["lengths"]).astype(np.int64)
    last = np.cumsum(lengths + 1) - 1
    token = np.empty(int(last[-1]) + 1, np.int32)
    word = np.ones(len(token), bool)
    word[last] = False
    token[word] = _by_count(unpack(row["counts"]).astype(np.int64))[unpack(row["tokens"])]
    token[last] = words
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
    place = (np.arange(len(token)) - np.repeat(last - lengths, lengths + 1)).astype(np.int32)
    return token, doc, place


class _Grams:
    """Distinct n-grams of a chunk, by shard, and the n-gram of every token that
    has a word before it; ``w1`` is -1 where there is one word only."""

    def __init__(self, token: np.ndarray, doc: np.ndarray, place: np.ndarray, ids: np.ndarray,
                 parts: np.ndarray, shards: int):
        at = np.flatnonzero(place >= 1)
        self.doc = doc[at]
        wide = np.int64(len(ids) + 1)
        w1 = np.where(place[at] >= 2, token[np.maximum(at - 2, 0)], -1)
        longer, which = _distinct(token[at - 1] * wide + w1 + 1)
        grams, self.gram = _distinct(which * wide + token[at])
        del at, w1, which
        of, self.w3 = np.divmod(grams, wide)
        self.w2, self.w1 = np.divmod(longer[of], wide)
        self.w1 -= 1
        shard = _shard_of(ids[self.w2], ids[self.w3], parts[self.w2], shards)
        self.order = np.argsort(shard, kind="stable")
        self.cuts = np.searchsorted(shard[self.order], np.arange(shards + 1))


def _emit(chunk: pd.DataFrame, vocabulary: pd.DataFrame, shards: int, ends: int, mass: int,
          hot: int) -> pd.DataFrame:
    """The chunk's distinct n-grams with training counts by shard, and what needs
    no context: base scores, known tokens, the first tokens' scores."""
    row = chunk.iloc[0]
    vocabulary = vocabulary.sort_values("part")
    ids = [(np.int64(p) << 40) + unpack_sorted(n).astype(np.int64)
           for p, n in zip(vocabulary["part"], vocabulary["numbers"])]
    known = [unpack(c).astype(np.int64) for c in vocabulary["counts"]]
    ids = np.concatenate([*ids, [_END]])
    count = np.concatenate([*known, [ends]])
    parts = _parts(count, hot)
    train = unpack(row["train"]).astype(np.int64)
    docs = len(train)
    token, doc, place = _tokens(row, len(ids) - 1)
    one = np.log10((count + 1) / mass)[token]
    base = np.bincount(doc, weights=one, minlength=docs)
    n_known = np.bincount(doc, weights=(count > 0)[token], minlength=docs)
    start = np.bincount(doc[place == 0], weights=one[place == 0], minlength=docs)
    grams = _Grams(token, doc, place, ids, parts, shards)
    del token, doc, place, one
    learnt = np.bincount(grams.gram, weights=train[grams.doc], minlength=len(grams.w3)).astype(np.int64)
    new = np.zeros(len(ids), np.int32)
    out = [(int(row["chunk"]) % shards, 0, join([
        pack(base), pack(n_known.astype(np.int64)), pack(-start), pack_sorted(ids), pack(parts)]), b"")]
    for s in np.flatnonzero(np.diff(grams.cuts)).tolist():
        at = grams.order[grams.cuts[s]:grams.cuts[s + 1]]
        w1, w2, w3 = grams.w1[at], grams.w2[at], grams.w3[at]
        own = np.unique(np.concatenate((w1, w2, w3)))
        own = own[own >= 0]
        new[own] = np.arange(len(own))
        out.append((s, len(at), b"", join([
            pack_sorted(ids[own]), pack(count[own]), pack(learnt[at]),
            pack(np.where(w1 >= 0, new[w1] + 1, 0)), pack_sorted(new[w2]), pack(new[w3])])))
    return pd.DataFrame({"shard": [s for s, _, _, _ in out], "chunk": int(row["chunk"]),
                         "n": [n for _, n, _, _ in out], "plain": [p for _, _, p, _ in out],
                         "grams": [g for _, _, _, g in out]})


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the place of each value among them."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(values) else np.zeros(0, bool)
    place = np.empty(len(values), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], place


class _Shard:
    """The n-grams of a shard with their training counts.

    What the chunks sent is unpacked ``BATCH_GRAMS`` at a time and folded into
    distinct n-grams, so an n-gram of every chunk is held once.
    """

    def __init__(self, pdf: pd.DataFrame, hot: int, shards: int):
        self.sent, self.n = pdf["grams"].tolist(), pdf["n"].to_numpy(np.int64)
        step = np.cumsum(self.n) // BATCH_GRAMS
        batches = np.split(np.arange(len(self.sent)), np.flatnonzero(np.diff(step)) + 1)
        self.ids, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            own = [split(self.sent[i])[:2] for i in batch]
            ids, first = np.unique(np.concatenate([self.ids, *(
                unpack_sorted(o).astype(np.int64) for o, _ in own)]), return_index=True)
            self.count = np.concatenate([self.count, *(unpack(c).astype(np.int64) for _, c in own)])[first]
            self.ids = ids
        words = self.words = np.int64(len(self.ids))
        self.longer = np.zeros(0, np.int64)  # context * (words + 1) + previous word + 1
        self.grams, self.learnt = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.place = None  # of every n-gram sent, where all fit a batch
        if len(batches) == 1:
            longer, w3, learnt = self.unpacked(batches[0])
            self.longer, which = _distinct(longer)
            del longer
            self.grams, self.place = _distinct(which * words + w3)
            self.learnt = np.bincount(self.place, weights=learnt, minlength=len(self.grams)).astype(np.int32)
            del which, w3, learnt
        else:
            for batch in batches:
                self.longer = np.unique(np.concatenate([self.longer, self.unpacked(batch)[0]]))
            for batch in batches:
                longer, w3, learnt = self.unpacked(batch)
                self.grams, place = _distinct(np.concatenate([self.grams, self.key(longer, w3)]))
                self.learnt = np.bincount(place, weights=np.concatenate([self.learnt, learnt]),
                                          minlength=len(self.grams)).astype(np.int64)
                del longer, w3, learnt, place
        self.of = (self.grams // words).astype(np.int32)
        self.w3 = (self.grams - self.of * words).astype(np.int32)
        self.w2 = self.longer // (words + 1)
        self.w1 = self.longer - self.w2 * (words + 1) - 1
        self.contexts, context = _distinct(self.w2)
        self.context = context.astype(np.int64)  # of every longer one
        self.pairs, self.pair = _distinct(self.context[self.of] * words + self.w3)
        self.pair_learnt = np.bincount(self.pair, weights=self.learnt, minlength=len(self.pairs)).astype(np.int64)
        self.far = self.w1[self.of] >= 0
        # Sums over a context's successors: tokens, then successors seen once, twice, more often.
        self.of_longer = _sums(self.learnt, self.of, len(self.longer))
        self.of_context = _sums(self.pair_learnt, self.pairs // words, len(self.contexts))
        # The contexts that other shards hold a part of.
        parts = _parts(self.count, hot)
        self.hot_longer = np.flatnonzero((parts[self.w2] > 1) & (self.w1 >= 0))
        self.hot_context = np.flatnonzero(parts[self.contexts] > 1)
        w2 = np.concatenate([self.w2[self.hot_longer], self.contexts[self.hot_context]])
        w1 = np.concatenate([self.w1[self.hot_longer], np.full(len(self.hot_context), -1)])
        self.hot_w2 = self.ids[w2]
        self.hot_w1 = np.concatenate([self.ids, [_NONE]])[w1]
        owner = _shard_of(self.hot_w2, self.hot_w1, parts[w2], shards)
        self.order = np.argsort(owner, kind="stable")
        self.owners, self.starts = np.unique(owner[self.order], return_index=True)

    def unpacked(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longer contexts (as in ``longer``), words and training counts of n-grams sent."""
        longer, third, learnt = [], [], []
        for i in which:
            own, _, c, w1, w2, w3 = split(self.sent[i])
            at = np.searchsorted(self.ids, unpack_sorted(own).astype(np.int64))
            longer.append(at[unpack_sorted(w2).astype(np.int64)] * (self.words + 1)
                          + np.concatenate(([0], at + 1))[unpack(w1)])
            third.append(at[unpack(w3)].astype(np.int32))
            learnt.append(unpack(c).astype(np.int32))
        return np.concatenate(longer), np.concatenate(third), np.concatenate(learnt)

    def key(self, longer: np.ndarray, w3: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.longer, longer) * self.words + w3

    def answers(self, steps: np.ndarray) -> Iterator[bytes]:
        """Each message's n-grams' steps, packed."""
        cuts = np.cumsum(self.n)
        for i in range(len(self.sent)):
            if self.place is not None:
                at = self.place[cuts[i] - self.n[i]:cuts[i]]
            else:
                at = np.searchsorted(self.grams, self.key(*self.unpacked([i])[:2]))
            yield pack(steps[at])

    def tally(self) -> np.ndarray:
        """Counts of counts of pairs and of triples."""
        return np.concatenate([np.bincount(np.minimum(c, 5), minlength=6)
                               for c in (self.pair_learnt, self.learnt[self.far])]).astype(np.int64)


def _sums(counts: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    kind = np.minimum(counts, 3)
    return np.stack([np.bincount(group, weights=counts if k == 0 else kind == k, minlength=groups)
                     for k in range(4)]).astype(np.int64)


def _told(pdf: pd.DataFrame, shards: int, hot: int) -> pd.DataFrame:
    """What a shard tells the owners of the contexts that it shares with others."""
    shard = int(pdf["shard"].iloc[0])
    pdf = pdf[pdf["n"] > 0].sort_values("chunk")
    out = []
    if len(pdf):
        held = _Shard(pdf, hot, shards)
        sums = np.concatenate([held.of_longer[:, held.hot_longer], held.of_context[:, held.hot_context]], axis=1)
        for o, at in zip(held.owners.tolist(), np.split(held.order, held.starts[1:])):
            out.append((o, b"", join([pack(held.hot_w2[at]), pack(held.hot_w1[at] + 1),
                                      *map(pack, sums[:, at])])))
        out.append((0, pack(held.tally()), b""))
    return pd.DataFrame({"owner": [o for o, _, _ in out], "shard": shard,
                         "tally": [t for _, t, _ in out], "sums": [m for _, _, m in out]})


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    """The owner's sums over all shards, to each of them in its order."""
    owner = int(pdf["owner"].iloc[0])
    pdf = pdf.sort_values("shard")
    tallies, asked = pdf[pdf["tally"].str.len() > 0], pdf[pdf["sums"].str.len() > 0]
    out = []
    if len(tallies):
        tally = pack(np.sum([unpack(t).astype(np.int64) for t in tallies["tally"]], axis=0))
        out += [(s, -1, tally, b"") for s in tallies["shard"]]
    if len(asked):
        lists = [[unpack(x).astype(np.int64) for x in split(m)] for m in asked["sums"]]
        w2, w1 = (np.concatenate([x[k] for x in lists]) for k in (0, 1))
        words, first = np.unique(w1, return_inverse=True)
        _, place = _distinct(np.unique(w2, return_inverse=True)[1] * np.int64(len(words)) + first)
        sums = [np.bincount(place, weights=np.concatenate([x[k] for x in lists])).astype(np.int64)[place]
                for k in range(2, 6)]
        cuts = np.cumsum([len(x[0]) for x in lists])[:-1]
        for s, *four in zip(asked["shard"], *(np.split(x, cuts) for x in sums)):
            out.append((s, owner, b"", join([pack(x) for x in four])))
    return pd.DataFrame({"shard": [s for s, _, _, _ in out], "owner": [o for _, o, _, _ in out],
                         "tally": [t for _, _, t, _ in out], "sums": [m for _, _, _, m in out]})


def _score(pdf: pd.DataFrame, sums: pd.DataFrame, mass: int, hot: int, shards: int) -> pd.DataFrame:
    """log10 probabilities of each chunk's n-grams of this shard, in steps."""
    if not len(pdf):
        return pd.DataFrame({"chunk": [], "shard": [], "plain": []})
    shard, plain = int(pdf["shard"].iloc[0]), pdf[pdf["n"] == 0]
    out = pd.DataFrame({"chunk": plain["chunk"], "shard": -1, "plain": plain["plain"]})
    pdf = pdf[pdf["n"] > 0].sort_values("chunk")
    if not len(pdf):
        return out
    held = _Shard(pdf, hot, shards)
    chunks = pdf["chunk"].tolist()
    del pdf
    sums = sums.sort_values("owner")
    tally = unpack(sums["tally"].iloc[0]).astype(np.int64).reshape(2, 6)
    whole = np.zeros((4, len(held.order)), np.int64)
    if len(held.order):
        whole[:, held.order] = np.concatenate(
            [np.stack([unpack(x).astype(np.int64) for x in split(m)]) for m in sums["sums"].iloc[1:]], axis=1)
    held.of_longer[:, held.hot_longer] = whole[:, :len(held.hot_longer)]
    held.of_context[:, held.hot_context] = whole[:, len(held.hot_longer):]
    words, context = held.words, held.context
    unigram = (held.count + 1) / mass
    known = held.pair_learnt > 0
    real = (held.of_longer[0] > 0) & (held.w1 >= 0)
    rename = np.cumsum(real) - 1
    seen = (held.learnt > 0) & held.far
    trie = Trie(len(held.contexts), int(words), held.pairs[known], held.pair_learnt[known],
                (context * words + held.w1)[real], rename[held.of[seen]] * words + held.w3[seen],
                held.learnt[seen], unigram, discounts_of(tally[0]), discounts_of(tally[1]),
                held.of_context, held.of_longer[:, real])
    pair_nodes, longer_nodes = trie.pair_nodes(held.pairs), np.where(real, rename, -1)
    steps = np.empty(len(held.grams), np.int64)
    for at in range(0, len(steps), VALUE_GRAMS):
        part = slice(at, at + VALUE_GRAMS)
        of, longer, pair = context[held.of[part]], longer_nodes[held.of[part]], pair_nodes[held.pair[part]]
        value = trie.log10(trie.triple_nodes(longer, of, pair), longer, of, pair, unigram[held.w3[part]])
        steps[part] = np.round(value / -SUM_STEP)
    return pd.concat([out, pd.DataFrame({"chunk": chunks, "shard": shard, "plain": list(held.answers(steps))})])


def _finish(docs: pd.DataFrame, parts: pd.DataFrame, shards: int) -> pd.DataFrame:
    row = docs.iloc[0]
    parts = parts.sort_values("shard")
    base, n_known, start, ids, split_by = map(unpack, split(parts["plain"].iloc[0]))
    ids = np.cumsum(ids, dtype=np.uint64).astype(np.int64)
    grams = _Grams(*_tokens(row, len(ids) - 1), ids, split_by.astype(np.int64), shards)
    steps = np.zeros(len(grams.w3), np.int64)
    if len(steps):
        steps[grams.order] = np.concatenate([unpack(p).astype(np.int64) for p in parts["plain"].iloc[1:]])
    total = np.bincount(grams.doc, weights=steps[grams.gram], minlength=len(start))
    lengths = unpack(row["lengths"]).astype(np.int64)
    return pd.DataFrame({"id": list(row["ids"]), "train": unpack(row["train"]) > 0,
                         "n_tokens": lengths + 1, "n_known": n_known.astype(np.int64),
                         "base_score": base, "score": -start - total * SUM_STEP})


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(id, train, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    ``train`` marks the rows to learn from (null: not).  Tokens are words
    between white space, ASCII letters lower-cased, and one end per text.  The
    base is the add-one unigram model; the score is the log10 probability of the
    text in the interpolated trigram model over it.

    Null and empty texts have the end only.  Without training rows every token
    has the base probability.  Repeated rows and null ids are rows of their own;
    other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    kind = rows.select("id").schema[0].dataType.simpleString()
    chunks = written(rows.mapInArrow(
        _chunks, f"chunk long, ids array<{kind}>, lengths binary, train binary, vocabulary binary, "
        "counts binary, tokens binary, n_vocabulary long, n_train_docs long, n_train_words long, "
        "n_words long"), "chunks")
    sums = chunks.agg(F.sum("n_train_docs").alias("d"), F.sum("n_train_words").alias("w"),
                      F.sum("n_words").alias("n")).first()
    ends, total = sums["d"] or 0, (sums["d"] or 0) + (sums["w"] or 0)
    vocabulary = _numbered(chunks)
    distinct = (vocabulary.agg(F.sum("distinct")).first()[0] or 0) + (ends > 0)
    mass = total + distinct + 1
    shards = max(1, math.ceil((sums["n"] or 0) / SHARD_TOKENS))
    hot = HOT_TOKENS

    def emit(chunk: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        return _emit(chunk, words, shards, ends, mass, hot)

    def told(pdf: pd.DataFrame) -> pd.DataFrame:
        return _told(pdf, shards, hot)

    def score(pdf: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        return _score(pdf, sums, mass, hot, shards)

    def finish(docs: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        return _finish(docs, parts, shards)

    # Both are read twice; equal exchanges are made once.
    texts = chunks.select("chunk", "ids", "lengths", "train", "counts", "tokens")
    sent = texts.groupBy("chunk").cogroup(
        vocabulary.select("chunk", "part", "numbers", "counts").groupBy("chunk")).applyInPandas(
        emit, "shard int, chunk long, n int, plain binary, grams binary")
    sums = sent.groupBy("shard").applyInPandas(
        told, "owner int, shard int, tally binary, sums binary").groupBy("owner").applyInPandas(
        _summed, "shard int, owner int, tally binary, sums binary")
    parts = sent.groupBy("shard").cogroup(sums.groupBy("shard")).applyInPandas(
        score, "chunk long, shard int, plain binary")
    out = texts.groupBy("chunk").cogroup(parts.groupBy("chunk")).applyInPandas(
        finish, f"id {kind}, train boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("id").alias(id_col), "train", "n_tokens", "n_known",
                      F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
