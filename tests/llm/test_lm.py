"""Language-model scores against a dictionary-based model of the same smoothing."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from larch.llm import lm, ngram_trie, queries

SF = "/root/testdata/sf0.01"


def tokens(t):
    return (t or "").encode().lower().split() + [None]


def brute(rows):
    """(text, train) -> n_tokens, n_known, N, base, score without quantisation."""
    count, pairs, triples = Counter(), Counter(), Counter()
    for t, train in rows:
        if train:
            w = tokens(t)
            count.update(w)
            pairs.update(zip(w, w[1:]))
            triples.update(zip(w, w[1:], w[2:]))
    total = sum(count.values())
    mass = total + len(count) + 1

    def level(grams):
        off = ngram_trie.discounts(np.array(list(grams.values()) or [0])[: len(grams)].astype(np.int64))
        sums, weight = Counter(), defaultdict(float)
        for g, c in grams.items():
            sums[g[:-1]] += c
            weight[g[:-1]] += off[min(c, 3)]
        return off, sums, weight
    o2, s2, v2 = level(pairs)
    o3, s3, v3 = level(triples)
    p1 = lambda w: (count[w] + 1) / mass

    def p2(a, w):
        if not s2[a,]:
            return p1(w)
        c = pairs[a, w]
        return (c - o2[min(c, 3)] if c else 0) / s2[a,] + v2[a,] / s2[a,] * p1(w)

    def p3(a, b, w):
        if not s3[a, b]:
            return p2(b, w)
        c = triples[a, b, w]
        return (c - o3[min(c, 3)] if c else 0) / s3[a, b] + v3[a, b] / s3[a, b] * p2(b, w)
    out = []
    for t, _ in rows:
        w = tokens(t)
        s = math.log10(p1(w[0])) + (math.log10(p2(w[0], w[1])) if len(w) > 1 else 0)
        s += sum(math.log10(p3(*g)) for g in zip(w, w[1:], w[2:]))
        out.append((len(w), sum(count[x] > 0 for x in w), total, sum(math.log10(p1(x)) for x in w), s))
    return out


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    train = [zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for r in docs]
    got = {r.doc_id: r for r in queries.QUERIES["op1_lm_score"](spark, SF).collect()}
    assert len(got) == len(docs)
    better = []
    for r, tr, want in zip(docs, train, brute([(r.text, t) for r, t in zip(docs, train)])):
        g = got[r.doc_id]
        assert g.held_out != tr and (g.n_tokens, g.n_known, g.train_tokens) == want[:3]
        assert g.base_score == pytest.approx(want[3], rel=1e-9)
        assert g.score == pytest.approx(want[4], rel=0.01, abs=0.2)
        if not tr:
            better.append(g.score - g.base_score)
    assert sum(better) > 0


def test_odd_rows_and_many_shards(spark, monkeypatch):
    rows = [(1, None, True), (2, "", False), (3, "a b a b a c", True), (3, "a b a b a c", True),
            (None, "x\x00y A\x0bB é", True), (5, "unseen words only here", False), (6, "a " * 3000, True),
            (7, " \t\n", True), (8, "word", None)] + [(10 + i, f"the {i % 7} of the {i % 5} end", i % 3 > 0) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").selectExpr("*", "1 AS score")
    monkeypatch.setattr(lm, "SHARD_TOKENS", 300)
    monkeypatch.setattr(lm, "VOCABULARY_ROWS", 5)
    got = sorted(lm.score_texts(df.repartition(3), df["learn"]).collect(), key=lambda r: (r.doc_id or -1, r.n_tokens))
    want = sorted(((r[0], *w) for r, w in zip(rows, brute([(t, bool(k)) for _, t, k in rows]))),
                  key=lambda r: (r[0] or -1, r[1]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g.doc_id, g.n_tokens, g.n_known, g.train_tokens) == w[:4]
        assert g.base_score == pytest.approx(w[4], rel=1e-9)
        assert math.isfinite(g.score) and g.score < 0
    empty = df.limit(0)
    assert lm.score_texts(empty, empty["learn"]).count() == 0
    none = [r for r in lm.score_texts(df, df["learn"].isNull() & (df["doc_id"] < 0)).collect()]
    assert all(r.score == pytest.approx(r.base_score) and r.n_known == 0 for r in none)


@pytest.mark.parametrize("hot,batch", [(3, 2_000_000), (20, 50), (10**9, 2_000_000)])
def test_scores_do_not_depend_on_hot_words_or_shards(spark, monkeypatch, hot, batch):
    """Shared contexts have whole counts and backoff weights, also of unseen pairs."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(words, 12, p=1 / np.arange(1, 41) / (1 / np.arange(1, 41)).sum())),
             i % 4 > 0) for i in range(150)]
    rows += [(200, "w0 w1", False), (201, "w0 w39 w38 w0 new w0", False), (202, "w0 " * 400, True),
             (203, "w0", True), (204, "the of the x", False), (205, "w0 w1 w0 the of", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 200)
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 300)
    monkeypatch.setattr(lm, "VOCABULARY_ROWS", 10)
    monkeypatch.setattr(lm, "HOT_TOKENS", hot)
    monkeypatch.setattr(lm, "BATCH_GRAMS", batch)
    got = {r.doc_id: r for r in lm.score_texts(df, df["learn"]).collect()}
    assert len(got) == len(rows)
    for r, want in zip(rows, brute([(t, k) for _, t, k in rows])):
        g = got[r[0]]
        assert (g.n_tokens, g.n_known, g.train_tokens) == want[:3]
        assert g.score == pytest.approx(want[4], rel=2e-4, abs=2e-3)


def test_a_repeated_pair_is_one_gram_of_its_chunk():
    tokens, doc = np.zeros(9000, np.int32), np.zeros(9000, np.int32)
    grams = lm._Grams(tokens, doc, np.arange(9000), np.array([5, 1 << 62]), np.array([7, 1]), 4)
    assert (grams.w1.tolist(), grams.w2.tolist(), grams.w3.tolist()) == ([-1, 0], [0, 0], [0, 0])
    assert np.bincount(grams.gram).tolist() == [1, 8998]


def test_elias_fano_round_trip_and_search():
    rng = np.random.default_rng(2)
    for n, u in ((0, 10), (1, 1), (5, 5), (3000, 3000), (20000, 10**12), (7000, 7100)):
        values = np.unique(rng.integers(0, u, n))
        ef = ngram_trie.EliasFano(values, u)
        assert ef.values(0, len(values)).tolist() == values.tolist()
        if len(values) > 100:
            assert ef.values(37, 90).tolist() == values[37:90].tolist()
        probe = np.unique(np.concatenate((values, rng.integers(0, u, 500))))
        at = {int(v): i for i, v in enumerate(values)}
        assert ef.find(probe).tolist() == [at.get(int(p), -1) for p in probe]


def test_levels_in_a_mapped_file(tmp_dir):
    with open(f"{tmp_dir}/trie", "w+b") as f:
        views = ngram_trie.mapped({"a": np.arange(5), "b": np.arange(3, dtype=np.uint8)}, f)
        assert views["a"].tolist() == [0, 1, 2, 3, 4] and views["b"].tolist() == [0, 1, 2]
