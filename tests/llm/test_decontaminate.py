"""Decontamination against brute force, and the index against plain search."""

import hashlib
import random
import re

import numpy as np
import pytest

from larch.llm import decontaminate, fmindex, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(texts, items, window=10):
    known = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            known.setdefault(tuple(w[i:i + window]), set()).add("" if item is None else str(item))
    lengths = {len(k) for k in known}
    out = []
    for t in texts:
        w, hit, names = words(t), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i:i + n])) in known:
                    hit.update(range(i, i + n))
                    names |= known[k]
        out.append((len(w), len(hit), sorted(names)))
    return out


def test_index_finds_every_occurrence():
    rng = random.Random(1)
    pieces = [np.array([rng.choice([0, 0, 1, 2, 3, 4, 5, 5]) for _ in range(rng.randint(0, 300))], np.int32)
              for _ in range(20)] + [np.full(500, 2, np.int32), np.zeros(50, np.int32)]
    index = fmindex.FMIndex(pieces, 5)
    begin = np.concatenate(([0], np.cumsum([len(p) + 1 for p in pieces])))
    for _ in range(200):
        n = rng.randint(1, 6)
        p = [rng.randint(1, 5) for _ in range(n)]
        low, high = index.search(np.array([[0] * (6 - n) + p]), np.array([n]))
        got = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        want = [int(begin[k]) + i for k, q in enumerate(pieces) for i in range(len(q) - n + 1)
                if q[i:i + n].tolist() == p]
        assert got == want


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in queries.QUERIES["op2_decontamination"](spark, SF).collect()}
    assert rows.keys() == docs.keys()
    for (doc, _), (n, hit, names) in zip(docs.items(), brute(docs.values(), items)):
        r = rows[doc]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(names), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
    assert any(r.contaminated for r in rows.values())


ITEMS = [(1, "The quick brown fox jumps over the lazy dog again and again today"), (2, "lone"), (3, None),
         (4, "..."), (None, "zwei wörter"), (5, "the the the the the the the the the the"), (5, "other text")]
TEXTS = [None, "", "...", "LONE", "a lone wolf", "the quick brown fox jumps over the lazy dog again", "the " * 50,
         "x the quick brown fox, jumps over THE lazy dog again and again today! x", "zwei-wörter ZWEI WÖRTER",
         "pad " * 3000 + "fox jumps over the lazy dog again and again today" + " pad" * 3000, "other\ntext", "a" * 50000]


@pytest.mark.parametrize("phrase_bytes,piece", [(1 << 20, 1 << 20), (30, 1 << 20), (1 << 20, 7)])
def test_odd_rows_batches_and_pieces(spark, monkeypatch, phrase_bytes, piece):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece)
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)] + [(None, "lone", 5), (4, "a lone wolf", 5)],
                                 "doc_id long, text string, n_hit long")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.find_leaks(docs, items, phrase_bytes=phrase_bytes).collect()
    assert len(got) == len(TEXTS) + 2
    if piece != 7:
        for r, want in zip(got, brute([r.text for r in got], ITEMS)):
            assert (r.n_words, r.n_hit, r.items) == want
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in decontaminate.find_leaks(docs, items.limit(0)).collect()} == {0}


def test_pieces_overlap():
    rng = random.Random(2)
    text = " ".join(rng.choice("abc") for _ in range(500)).encode()
    items = [(str(i), " ".join(rng.choice("abc") for _ in range(4)).encode()) for i in range(30)]
    phrases = decontaminate.Phrases(items, 4)
    whole = decontaminate.search([text], phrases)[0]
    decontaminate.PIECE_WORDS, old = 13, decontaminate.PIECE_WORDS
    try:
        parts = decontaminate.search([text], phrases)[0]
    finally:
        decontaminate.PIECE_WORDS = old
    assert whole[0] == parts[0] and whole[1].tolist() == parts[1].tolist() and whole[2] == parts[2]


def test_removal(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_chars long")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.without_leaks(docs, items)
    assert out.columns == docs.columns
    kept = {r.doc_id: r for r in out.collect()}
    assert kept[4].text == "a   wolf" and kept[4].n_chars == 8
    assert kept[7].text == "x  ! x"
    assert 3 not in kept and 5 not in kept and kept[0].text is None and kept[11].n_chars == 0
    assert all(h == 0 for _, h, _ in brute([r.text for r in kept.values()], ITEMS))
