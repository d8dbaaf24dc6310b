"""Fixture sizes and k-means figures at sf0.01, as recorded in FIXTURES.md."""

import pytest

from larch.operators import clusters
from larch.plans import fixtures
from tests.conftest import SF_CHECK


def test_fixture_sizes(spark):
    assert fixtures.ratings(spark, SF_CHECK).count() == 28762
    assert fixtures.order_baskets(spark, SF_CHECK).count() == 14743
    assert fixtures.nation_parts(spark, SF_CHECK).count() == 34730
    assert fixtures.customer_brands(spark, SF_CHECK).count() == 28762
    lab = fixtures.labelled(spark, SF_CHECK)
    assert lab.count() == 2000 and lab.where("label IS NULL").count() == 1008


@pytest.fixture(scope="module")
def cells(spark):
    return fixtures.customer_brands(spark, SF_CHECK).cache()


def test_kmeans_figures(spark, cells):
    init = [r.entity for r in clusters.init_centroids(cells, 4, 42).orderBy("cluster").collect()]
    assert init == [897, 1443, 1078, 47]
    sizes = {1: [290, 897, 153, 160], 3: [289, 769, 218, 224], 5: [274, 746, 231, 249]}
    layout = clusters.lay_out(cells)
    rounds = 0
    for kept, _ in clusters.lloyd_rounds(layout, clusters.init_centroids(cells, 4, 42), 4):
        rounds += 1
        if rounds in sizes:
            got = dict((r.cluster, r.n) for r in clusters.cluster_sizes(kept).collect())
            assert [got[c] for c in range(4)] == sizes[rounds]
    layout.release()
    assert rounds == 18
