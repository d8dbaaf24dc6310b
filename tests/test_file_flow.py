"""End-to-end over text files the test writes: baskets from ragged lines,
FP-Growth on them, and the transposed membership (state x plant) used for
lookups, distances and k-means."""

import os
from itertools import combinations

from larch.operators import baskets, clusters, membership
from larch.sources import read_lines

LINES = [
    "abies,qc,on,nb", "acer,qc,on,ny,vt", "betula,qc,on,ny", "carex,ca,az,nv",
    "yucca,ca,az,nm,tx", "zea,ny,vt,qc", "opuntia,az,nm,tx,ca", "pinus,on,nb,qc,ny",
    "quercus,tx,nm,az", "salix", "rosa,qc,on,qc",
]


def write(tmp_dir):
    path = os.path.join(tmp_dir, "plants.txt")
    with open(path, "w") as f:
        f.write("\n".join(LINES) + "\n")
    return path


def test_basket_flow(spark, tmp_dir):
    lines = read_lines(spark, write(tmp_dir))
    table = baskets.basket_table(lines)
    rows = table.collect()
    assert [(r.id, r.name) for r in rows] == [(i, l.split(",")[0]) for i, l in enumerate(LINES)]
    assert list(rows[9]["items"]) == [] and list(rows[10]["items"]) == ["qc", "on", "qc"]
    assert [r.id for r in baskets.basket_table(lines, n=3).collect()] == [0, 1, 2]

    model = baskets.fit(table, 0.25, 0.6)
    sets = [set(l.split(",")[1:]) for l in LINES]
    got = {tuple(r["items"]): r.freq for r in baskets.frequent_itemsets(model).collect()}
    for items, freq in got.items():
        assert freq == sum(1 for s in sets if set(items) <= s) >= 3
    assert ("on", "qc") in got and ("az", "ca") in got


def test_membership_flow(spark, tmp_dir):
    table = baskets.basket_table(read_lines(spark, write(tmp_dir)))
    cells = membership.membership_from_baskets(table).cache()  # (state, plant)
    assert membership.lookup(cells, "qc", "abies").first().present
    assert not membership.lookup(cells, "tx", "abies").first().present
    plants = {}
    for l in LINES:
        name, *states = l.split(",")
        for s in states:
            plants.setdefault(s, set()).add(name)
    want = {(a, b): len(plants[a] ^ plants[b]) for a, b in combinations(sorted(plants), 2)}
    pairs = spark.createDataFrame(sorted(want), "a string, b string")
    got = {(r.a, r.b): r.distance for r in membership.pair_distances(cells, pairs).collect()}
    assert got == want
    assert membership.pair_distance(cells, "qc", "az").first().distance == want[("az", "qc")]

    res = clusters.kmeans(cells, 2, 7)
    groups = {}
    for r in res.assignment.collect():
        groups.setdefault(r.cluster, set()).add(r.entity)
    # East and south-west separate.
    assert any({"qc", "on"} <= g for g in groups.values())
    assert any({"az", "tx"} <= g for g in groups.values())
    assert all(not ({"qc", "az"} <= g) for g in groups.values())
    res.release()
