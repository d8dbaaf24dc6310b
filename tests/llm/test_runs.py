import hashlib
import random
import zlib

import numpy as np
import pytest

from larch.llm import runs
from larch.llm.queries import _with_repeats, op12_periodic_runs

from tests.conftest import SF_CHECK


def brute(words, least=24, exponent=3):
    """Stretches that agree with themselves q words on, for every q from the smallest."""
    found = {}
    n = len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, exponent * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _made(rng):
    letters, n = rng.choice([1, 2, 2, 3, 5]), rng.randint(0, 80)
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 4:
            start, period = rng.randrange(n), rng.randint(1, 8)
            for i in range(start + period, min(n, start + rng.randint(1, 60))):
                words[i] = words[i - period]
    return words


@pytest.mark.parametrize("many", [0, 1, 16])
def test_runs_equal_brute_force(monkeypatch, many):
    monkeypatch.setattr(runs, "MANY_CLASSES", many)
    rng, total = random.Random(many), 0
    for _ in range(600):
        least, exponent = rng.choice([(24, 3), (6, 3), (1, 3), (9, 4), (3, 3)])
        docs = [_made(rng) for _ in range(rng.randint(1, 5))]
        got = runs.find_runs(np.array([w for d in docs for w in d], np.int64),
                             np.array([len(d) for d in docs]), least, exponent)
        want = [brute(d, least, exponent) for d in docs]
        assert got == want
        total += sum(map(len, want))
    assert total > 1000


def test_long_texts_take_little_more_than_their_length():
    words = np.array([0, 1] * 40_000 + list(range(20)) * 2_000, np.int64)
    assert runs.find_runs(words, np.array([len(words)]))[0] == [(0, 80_002, 2), (80_000, 40_000, 20)]
    # One passage after 3,000 different words, before 3,000 others: no run.
    star = [w for i in range(3000) for w in [*range(20), 100 + i * 7919 % 9973]]
    assert runs.find_runs(np.array(star, np.int64), np.array([len(star)])) == [[]]


def test_settings_out_of_range():
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(3, np.int64), np.array([3]), exponent=2)


def test_odd_rows(spark):
    line = "a b c " * 9
    rows = [(1, None, "x"), (2, "", None), (3, " \t\n", "y"), (4, line, "z"), (4, line, "z"),
            (None, "x y", "w")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, collapsed string")
    got = runs.with_runs(docs, collapsed_col="kept").collect()
    assert sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["kept"], r["collapsed"])
                   for r in got), key=str) == sorted([
        (1, [], "", "x"), (2, [], "", None), (3, [], "", "y"), (4, [(0, 27, 3)], "a b c", "z"),
        (4, [(0, 27, 3)], "a b c", "z"), (None, [], "x y", "w")], key=str)
    assert runs.with_runs(docs).columns == ["doc_id", "text", "collapsed", "runs"]
    assert runs.with_runs(docs.limit(0)).count() == 0


def test_repeated_texts_of_the_query(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    docs = spark.createDataFrame(
        [(ids[0], None), (ids[1], " \n"), (ids[2], "only"), (None, "a  b")], "doc_id long, text string")
    got = {r["doc_id"]: r["collapsed"] for r in runs.with_runs(_with_repeats(docs)).collect()}
    assert got == {ids[0]: "", ids[1]: "", ids[2]: "only", None: "a b"}


def test_query_equals_brute_force(spark):
    def sha(text):
        return hashlib.sha256(text).hexdigest()

    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, SF_CHECK).collect()}
    assert len(got) == len(docs)
    with_runs = 0
    for doc in docs:
        words = (doc["text"] or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc["doc_id"]).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        # Long texts: every period of every stretch would take too long here.
        if n > 3000:
            continue
        found = brute(words)
        with_runs += bool(found)
        row = got[doc["doc_id"]]
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(found), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert row["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in found).encode())
        assert row["collapsed_sha256"] == sha(b" ".join(
            w for i, w in enumerate(words) if i not in gone))
    assert with_runs > 50
