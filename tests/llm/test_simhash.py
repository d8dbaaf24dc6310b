"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import xxhash

from larch.llm import graph, queries, simhash

SF = "/root/testdata/sf0.01"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = ([b" ".join(words)] if len(words) < 3 else
                [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, radius=3):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    arr = np.array(sorted(set(fps)), np.uint64)
    for i, f in enumerate(arr):
        near = np.bitwise_count(arr[i + 1:] ^ f) <= radius
        for g in arr[i + 1:][near]:
            a, b = find(int(f)), find(int(g))
            if a != b:
                parent[max(a, b)] = min(a, b)
    return {f: find(f) for f in fps}


def check(rows, want_fp):
    fps = [want_fp(r) for r in rows]
    comp = brute_components(fps)
    least = {}
    for r, f in zip(rows, fps):
        if r.doc_id is not None:
            least[comp[f]] = min(least.get(comp[f], r.doc_id), r.doc_id)
    for r, f in zip(rows, fps):
        assert r.component_id == least.get(comp[f])


def test_fingerprints_and_components(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op8_simhash"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert int(r.fingerprint, 16) == brute_fingerprint(texts[r.doc_id])
    check(rows, lambda r: int(r.fingerprint, 16))


def test_planted_distances_all_block_schemes():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(300)]
    fps = set(base)
    for f in base[:120]:
        for _ in range(rng.randint(1, 5)):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 5)):
                g ^= 1 << b
            fps.add(g)
    arr = np.array(sorted(fps), np.uint64)
    want = {(i, j) for i in range(len(arr)) for j in range(i + 1, len(arr))
            if bin(int(arr[i] ^ arr[j])).count("1") <= 3}
    got = {(int(q), int(m)) for qs, ms in simhash.close_pairs(arr, arr, 3, True) for q, m in zip(qs, ms)}
    assert got == want
    half = len(arr) // 2
    cross = {(int(q), int(m)) for qs, ms in simhash.close_pairs(arr[:half], arr[half:], 3, False)
             for q, m in zip(qs, ms)}
    assert cross == {(i, j - half) for i, j in want if i < half <= j}
    for blocks in (4, 5, 6, 7):
        masks = simhash.keys(3, blocks)
        for i, j in want:
            assert any((int(arr[i]) & m) == (int(arr[j]) & m) for m in masks)
    for radius in (0, 1, 2, 4, 5):
        got = {(int(q), int(m)) for qs, ms in simhash.close_pairs(arr, arr, radius, True)
               for q, m in zip(qs, ms)}
        assert got == {(i, j) for i in range(len(arr)) for j in range(i + 1, len(arr))
                       if bin(int(arr[i] ^ arr[j])).count("1") <= radius}


def test_split_blocks_lose_no_link(spark):
    rng = random.Random(5)
    hot = rng.getrandbits(64)
    fps = {hot ^ (1 << a) ^ (1 << b) for a in range(16) for b in range(16)}
    fps |= {rng.getrandbits(64) for _ in range(400)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fingerprint long")
    edges = simhash.near_edges(df, 3, block_rows=64, block_limit=40)
    got = {r.node: r.component for r in graph.components(edges).collect()}
    comp = brute_components(list(fps))
    sizes = {}
    for f in fps:
        sizes.setdefault(comp[f], []).append(f - (1 << 64) if f >> 63 else f)
    for members in sizes.values():
        if len(members) == 1:
            assert members[0] not in got
        else:
            assert {got[m] for m in members} == {min(members)}


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "one two", "x"), (5, "ONE  two", "x"),
            (5, "ONE  two", "x"), (None, "one two", "x"), (7, "a b c d e f", "x"),
            (None, "entirely different words stand here", "x"), (9, "w " * 200000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = simhash.near_duplicates(df)
    out = got.collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add(r.component_id)
    assert by[1] == by[2] == by[3] == {1}
    assert by[4] == by[5] == {4}
    assert by[None] == {4, None}
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "7", "9", "None", "None"]
    empty = df.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.component for r in graph.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(101)) and all(got[1000 + i] == 1000 for i in range(200))
