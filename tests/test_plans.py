"""Physical-plan checks over every registered query: no Cartesian or
nested-loop joins, no Python, and column pruning at the Parquet scans."""

import gc
import re

import pytest

from tests.conftest import SF_SMALL

from larch.plans.queries import QUERIES


def executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = executed_plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, f"{name}: {bad}"
    assert "FlatMapGroupsInPandas" not in plan and "ArrowEvalPython" not in plan, name
    # Scans of the tables read only the columns the query needs; stored layouts hold
    # nothing else.
    for scan in re.findall(r"FileScan parquet.*", plan):
        schema = re.search(r"ReadSchema: struct<([^>]*)>", scan)
        if "larch-test-ckpt" not in scan and schema:
            assert len(schema[1].split(",")) <= 5, f"{name}: wide scan {schema[1]}"


def join_sides(plan: str, key: str) -> list[list[str]]:
    """Lines from each sort-merge join on ``key`` down to the cached cells."""
    lines = plan.split("\n")
    out = []
    for i, line in enumerate(lines):
        if "SortMergeJoin" in line and key in line and "_salt" in line:
            side = []
            for below in lines[i + 1:]:
                side.append(below)
                if "InMemoryTableScan" in below:
                    break
            out.append(side)
    return out


def test_kmeans_rounds_keep_cells_in_place(spark):
    """Neither join of the cached cells may shuffle them, even when nothing is
    broadcast (large tables)."""
    from larch.operators import clusters
    from larch.plans import fixtures

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = fixtures.customer_brands(spark, SF_SMALL)
        layout = clusters.lay_out(cells)
        init = clusters.init_centroids(cells, 4, 42)
        centroids = clusters.centroid_stats(layout, init, 4)
        for df, key in ((clusters.assign(layout, centroids), "feature"),
                        (clusters.cluster_weights(layout, init, 4), "entity")):
            sides = join_sides(executed_plan(df), key)
            assert sides
            assert any(not any("Exchange" in line for line in side) for side in sides), sides
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.catalog.clearCache()


def test_basket_ids_have_no_single_partition(spark):
    assert "SinglePartition" not in executed_plan(QUERIES["baskets"](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["global_mean_rmse", "means_interaction", "frequent_itemsets", "membership_sets"])
def test_queries_leave_no_cache_behind(spark, name):
    def kept():
        # Others may hold RDDs of their own (MLlib's wait for the cleaner).
        return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())

    spark.catalog.clearCache()
    gc.collect()
    before = kept()
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    assert kept() - before
    del df
    gc.collect()
    assert not kept() - before
