"""Benchmark decontamination: an FM-index of every block of training texts,
searched for the phrases of the benchmark; hit words merge into removal spans."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larch.llm import fmindex
from larch.llm.common import text_or_empty

WINDOW = 10
#: Text bytes indexed together, words of a longer text in one piece, benchmark
#: bytes searched in one pass, occurrences located at a time.
SHARD_BYTES = 8 << 20
PIECE_WORDS = 1 << 20
PHRASE_BYTES = 32 << 20
LOCATE_ROWS = 1 << 20


class Phrases:
    """Distinct windows of benchmark items, as numbers of their words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        hashed = [(name, fmindex.word_hashes(text)) for name, text in items]
        hashed = [(name, h) for name, h in hashed if len(h)]
        self.vocabulary = np.unique(np.concatenate([h for _, h in hashed])) if hashed else \
            np.zeros(0, np.uint64)
        self.names = sorted({name for name, _ in hashed})
        number = {name: i for i, name in enumerate(self.names)}
        known: dict[bytes, int] = {}
        owners: list[set[int]] = []
        for name, h in hashed:
            symbols = (np.searchsorted(self.vocabulary, h) + 1).astype(np.int64)
            for at in range(max(1, len(symbols) - window + 1)):
                key = symbols[at:at + window].tobytes()
                i = known.setdefault(key, len(known))
                if i == len(owners):
                    owners.append(set())
                owners[i].add(number[name])
        self.lengths = np.array([len(k) // 8 for k in known], np.int64)
        self.symbols = np.zeros((len(known), window), np.int64)
        for i, key in enumerate(known):
            row = np.frombuffer(key, np.int64)
            self.symbols[i, window - len(row):] = row
        self.owner_at = np.concatenate(([0], np.cumsum([len(o) for o in owners]))).astype(np.int64)
        self.owner = np.array([x for o in owners for x in sorted(o)], np.int64)

    def numbered(self, data: bytes) -> np.ndarray:
        """Words of a text as phrase symbols; 0 where no phrase has the word."""
        h = fmindex.word_hashes(data)
        if not len(self.vocabulary):
            return np.zeros(len(h), np.int32)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at + 1, 0).astype(np.int32)


def search(texts: list[bytes], phrases: Phrases) -> list[tuple[int, np.ndarray, list[str]]]:
    """Per text: number of words, hit words as runs ``[start, end)``, and the
    names of the items with occurring windows."""
    texts_symbols = [phrases.numbered(t) for t in texts]
    window = phrases.symbols.shape[1]
    pieces, owner, offset = [], [], []
    for i, symbols in enumerate(texts_symbols):
        # Pieces of one text overlap by a window less one word.
        for at in range(0, max(1, len(symbols)), PIECE_WORDS):
            pieces.append(symbols[at:at + PIECE_WORDS + window - 1])
            owner.append(i)
            offset.append(at)
    # Where windows begin and end, over the words of all texts one after another.
    word_at = np.concatenate(([0], np.cumsum([len(s) + 1 for s in texts_symbols]))).astype(np.int64)
    cover = np.zeros(int(word_at[-1]) + 1, np.int32)
    owner_of, offset_of = np.array(owner, np.int64), np.array(offset, np.int64)
    pairs = []
    if len(phrases.lengths):
        begin = np.concatenate(([0], np.cumsum([len(p) + 1 for p in pieces])))
        for first in range(0, len(pieces), 1 << 16):
            part = pieces[first:first + (1 << 16)]
            index = fmindex.FMIndex(part, len(phrases.vocabulary))
            low, high = index.search(phrases.symbols, phrases.lengths)
            hit = np.flatnonzero(high > low)
            sizes = (high - low)[hit]
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            for at in range(0, int(bounds[-1]), LOCATE_ROWS):
                nth = np.arange(at, min(at + LOCATE_ROWS, int(bounds[-1])))
                which = np.searchsorted(bounds, nth, side="right") - 1
                rows = low[hit[which]] + nth - bounds[which]
                places = index.locate(rows) + begin[first]
                phrase = hit[which]
                piece = np.searchsorted(begin, places, side="right") - 1
                text = owner_of[piece]
                word = word_at[text] + places - begin[piece] + offset_of[piece]
                np.add.at(cover, word, 1)
                np.add.at(cover, word + phrases.lengths[phrase], -1)
                pairs.append(np.unique(text * np.int64(len(phrases.lengths)) + phrase))
    items: dict[int, set[int]] = {}
    for pair in np.unique(np.concatenate(pairs)) if pairs else ():
        text, phrase = divmod(int(pair), len(phrases.lengths))
        items.setdefault(text, set()).update(
            phrases.owner[phrases.owner_at[phrase]:phrases.owner_at[phrase + 1]].tolist())
    out = []
    for i, symbols in enumerate(texts_symbols):
        if i not in items:
            out.append((len(symbols), np.zeros((0, 2), np.int64), []))
            continue
        own = cover[word_at[i]:word_at[i + 1] - 1]
        hit = np.concatenate(([False], np.cumsum(own) > 0, [False]))
        turns = np.flatnonzero(hit[1:] != hit[:-1])
        out.append((len(symbols), turns.reshape(-1, 2), sorted(phrases.names[x] for x in items[i])))
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of two lists of runs."""
    if not len(a) or not len(b):
        return a if len(a) else b
    every = np.concatenate((a, b))
    every = every[np.argsort(every[:, 0], kind="stable")]
    out = [every[0].tolist()]
    for s, e in every[1:].tolist():
        if s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return np.array(out)


def cut(data: bytes, runs: np.ndarray) -> tuple[list[dict], str]:
    """Removal spans in code points (from the first to the last hit word of a
    run) and the text without them; a space stands in for each."""
    _, starts, ends = fmindex.word_bounds(data)
    chars = np.concatenate(([0], np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)))
    spans, kept, at = [], [], 0
    for s, e in runs.tolist():
        a, b = int(starts[s]), int(ends[e - 1])
        spans.append({"start": int(chars[a]), "end": int(chars[b])})
        kept += [data[at:a], b" "]
        at = b
    return spans, b"".join([*kept, data[at:]]).decode()


_RUNS = T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType())]))
ADDED = {"n_words": T.LongType(), "n_hit": T.LongType(), "items": T.ArrayType(T.StringType()),
         "spans": _SPANS, "cleaned": T.StringType()}


def find_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
               keep: list[str] | None = None, phrase_bytes: int = PHRASE_BYTES) -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` (default: all) with
    ``n_words``, ``n_hit`` (words inside an occurrence of a window of ``window``
    item words), ``items`` (ids, as strings, of items with occurring windows),
    ``spans`` (merged removal spans, code points) and ``cleaned`` (the text
    without them; null when nothing was hit).

    Each task indexes its texts in shards of about ``SHARD_BYTES`` and searches
    all phrases of one bounded batch of items; more items than fit in one batch
    make further passes, which carry the hits found before.  Texts longer than a
    piece are indexed in overlapping pieces.

    Null and empty texts have no words; items without words are ignored; a null
    item id counts as the empty string.  Repeated rows are treated alike.
    Columns with the names of added ones are replaced.  Empty tables on either
    side are fine.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    size = items.agg(F.sum(F.octet_length(text_or_empty(item_text_col)) + 1)).first()[0] or 0
    batches = max(1, math.ceil(size / phrase_bytes))
    listed = items.select(
        F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("i"),
        text_or_empty(item_text_col).cast("binary").alias("t")).withColumn(
        "b", F.pmod(F.xxhash64("i", "t"), F.lit(batches)))
    state = docs.select(*names, text_or_empty(text_col).cast("binary").alias("_text"))
    for batch in range(batches):
        # At most about phrase_bytes of item text.
        phrases = Phrases([(r["i"], bytes(r["t"])) for r in
                           listed.where(F.col("b") == batch).collect()], window)
        state = _pass(state, names, docs.sparkSession.sparkContext.broadcast(phrases),
                      batch == batches - 1)
    return state


def _pass(state: DataFrame, names: list[str], phrases, last: bool) -> DataFrame:
    fields = [state.schema[c] for c in names]
    if last:
        fields += [T.StructField(c, t) for c, t in ADDED.items()]
    else:
        fields += [T.StructField("_text", T.BinaryType()), T.StructField("_runs", _RUNS),
                   T.StructField("_items", T.ArrayType(T.StringType()))]
    schema = T.StructType(fields)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def finished(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t.as_py() for b in held for t in b.column("_text")]
        found = iter(search(texts, phrases.value))
        at = 0
        for b in held:
            rows = {c: [] for c in (ADDED if last else ("_runs", "_items"))}
            before = b.schema.get_field_index("_runs") >= 0
            for i in range(b.num_rows):
                n, runs, items = next(found)
                if before:
                    old = [(r["s"], r["e"]) for r in b.column("_runs")[i].as_py()]
                    runs = merged(np.array(old, np.int64).reshape(-1, 2), runs)
                    items = sorted({*items, *b.column("_items")[i].as_py()})
                if last:
                    spans, cleaned = cut(texts[at + i], runs) if len(runs) else ([], None)
                    rows["n_words"].append(n)
                    rows["n_hit"].append(int((runs[:, 1] - runs[:, 0]).sum()))
                    rows["items"].append(items)
                    rows["spans"].append(spans)
                    rows["cleaned"].append(cleaned)
                else:
                    rows["_runs"].append([{"s": s, "e": e} for s, e in runs.tolist()])
                    rows["_items"].append(items)
            at += b.num_rows
            columns = [b.column(c) for c in names] + ([] if last else [b.column("_text")])
            new = [pa.array(v, arrow.field(c).type) for c, v in rows.items()]
            yield pa.RecordBatch.from_arrays(
                [c.cast(arrow.field(i).type) for i, c in enumerate(columns)] + new, schema=arrow)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            lengths = np.array([len(t.as_buffer()) for t in batch.column("_text")], np.int64)
            at = 0
            while at < batch.num_rows:
                sums = size + np.cumsum(lengths[at:])
                take = int(np.searchsorted(sums, SHARD_BYTES)) + 1
                part = batch.slice(at, take)
                held.append(part)
                size += int(lengths[at:at + take].sum())
                at += take
                if size >= SHARD_BYTES:
                    yield from finished(held)
                    held, size = [], 0
        if held:
            yield from finished(held)

    return state.mapInArrow(indexed, schema)


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text",
                  length_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with all removal spans cut out of the texts (and the length
    column, where there is one, set anew); rows without words left are dropped.
    Rows without a hit stay as they are."""
    named = [F.col(c).alias(f"_{i}") for i, c in enumerate(docs.columns)]
    at = {c: F.col(f"_{i}") for i, c in enumerate(docs.columns)}
    text = f"_{docs.columns.index(text_col)}"
    found = find_leaks(docs.select(*named), items, text, **options)
    out = found.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words")))
    changed = F.col("cleaned").isNotNull()
    at[text_col] = F.when(changed, F.col("cleaned")).otherwise(at[text_col])
    if length_col in docs.columns:
        at[length_col] = F.when(changed, F.length("cleaned").cast(
            docs.schema[length_col].dataType)).otherwise(at[length_col])
    return out.select(*[at[c].alias(c) for c in docs.columns])
