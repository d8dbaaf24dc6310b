"""The corpus pipeline, stage by stage, against brute force."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from larch.llm.common import written
from test_decontaminate import brute as leaks
from test_shards import verify
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def key(r):
    return r.doc_id, r.text


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "mixing", "sharding"]
    before = docs.collect()
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        after = docs.collect()
        if name != "sharding":
            assert docs.columns == COLUMNS
        was = Counter(map(key, before))
        if name == "toxicity":
            gone = {r.doc_id for r in before} - {r.doc_id for r in after}
            known = [r.doc_id for r in before if r.doc_id in labels]
            assert sum((d in gone) == bool(labels[d]) for d in known) >= 0.9 * len(known)
            assert not Counter(map(key, after)) - was
        elif name == "simhash":
            fps = {key(r): brute_fingerprint(r.text) for r in before}
            comp = brute_components(list(fps.values()))
            first = {}
            for r in before:
                c = comp[fps[key(r)]]
                first[c] = min(first.get(c, r.doc_id), r.doc_id)
            assert sorted(r.doc_id for r in after) == sorted(first.values())
        elif name == "decontamination":
            texts = {r.doc_id: r.text for r in after}
            for r, (n, hit, _) in zip(before, leaks([r.text for r in before], items)):
                if hit == 0:
                    assert texts[r.doc_id] == r.text
                elif hit == n:
                    assert r.doc_id not in texts
                else:
                    assert len(texts[r.doc_id]) < len(r.text)
            assert all(hit == 0 for _, hit, _ in leaks([r.text for r in after], items))
            assert all(r.n_chars == len(r.text) for r in after)
        elif name == "mixing":
            now = Counter(map(key, after))
            assert set(now) <= set(was) and now != was
            assert len(now) > 0.8 * len(was)
        else:
            assert Counter(map(key, after)) == was
            verify(after, pipeline.SHARDS)
            places = defaultdict(set)
            for r in after:
                places[r.text].add(r.shard)
            assert sum(len(p) > 1 for p in places.values()) <= 0.02 * len(places) + 1
        before = after


def test_empty_and_odd_documents(spark):
    odd = spark.createDataFrame(
        [(1, None, "en", "s", 0, 1), (2, "", "en", "s", 0, 1), (None, "some words here", None, None, None, 1),
         (4, "x " * 20000, "en", "s", 40000, 1), (4, "x " * 20000, "en", "s", 40000, 1), (5, "a b c", "en", "s", 5, 1)],
        "doc_id long, text string, lang string, source string, n_chars long, shard int")
    for docs in (odd, odd.limit(0)):
        for name, stage in pipeline.STAGES:
            docs = written(stage(spark, docs, SF), name)
            assert name == "sharding" or docs.columns == COLUMNS + ["shard"]
        verify(docs.collect(), pipeline.SHARDS)
