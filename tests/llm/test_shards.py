"""Balanced label propagation: sizes, slots and cut edges."""

from collections import Counter, defaultdict

from larch.llm import queries, shards

SF = "/root/testdata/sf0.01"


def verify(rows, n):
    sizes = Counter(r.shard for r in rows)
    assert sum(sizes.values()) == len(rows)
    counts = [sizes.get(j, 0) for j in range(n)]
    assert max(counts) - min(counts) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_label_propagation"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    verify(rows, 8)
    groups = defaultdict(set)
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 1
        groups[texts[r.doc_id]].add(r.shard)
    split = sum(len(s) > 1 for s in groups.values())
    assert split <= 0.05 * sum(v > 1 for v in Counter(texts.values()).values())


def test_group_larger_than_a_shard_and_odd_rows(spark):
    rows = ([(i, "same text", 0) for i in range(60)] + [(100, None, 0), (101, "", 0), (None, "x", 0)]
            + [(200 + i, f"text {i}", 0) for i in range(40)] + [(200, "text 0", 0)] * 2)
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = shards.shard_documents(df, 4)
    out = got.collect()
    assert len(out) == len(rows)
    verify(out, 4)
    assert len({r.shard for r in out if r.text in (None, "")}) == 1
    assert shards.shard_documents(df.limit(0), 4).count() == 0
    one = shards.shard_documents(df.limit(1), 4).collect()
    assert [(r.shard, r.slot) for r in one] in [[(j, 0)] for j in range(4)]


def test_general_links_lower_the_cut(spark):
    # Eight rings of 50 nodes, neighbours linked.
    links = [(50 * g + i, 50 * g + (i + d) % 50) for g in range(8) for i in range(50) for d in (1, 2, 3)]
    nodes = spark.range(400).withColumnRenamed("id", "node")
    got = {r.node: r.shard for r in shards.balanced_shards(
        nodes, spark.createDataFrame(links, "a long, b long"), 4).collect()}
    cut = sum(got[a] != got[b] for a, b in links)
    assert cut < 0.6 * len(links)
    assert sorted(Counter(got.values()).values()) == [100] * 4
