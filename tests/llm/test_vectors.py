"""Subspace pigeonhole join against brute force."""

import numpy as np
import pytest

from larch.llm import queries, vectors

SF = "/root/testdata/sf0.01"


def brute(rows, cosine=0.95):
    def ok(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    unit = [np.array(v, float) / np.linalg.norm(v) if ok(v) else None for _, v in rows]
    n = len(rows)
    adj = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None
            and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(n)]
    comp = [None] * n
    for i in range(n):
        if comp[i] is None:
            seen, todo = {i}, [i]
            while todo:
                for y in adj[todo.pop()]:
                    if y not in seen:
                        seen.add(y)
                        todo.append(y)
            ids = [rows[k][0] for k in seen if rows[k][0] is not None]
            for k in seen:
                comp[k] = min(ids) if ids else None, len(seen)
    return sorted(((rows[i][0], len(adj[i]), comp[i][0]) for i in range(n)), key=str)


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.QUERIES["op6_subspace_join"](spark, SF).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("grid,part", [(1, 16384), (2, 16384), (3, 40), (1, 25)])
def test_near_copies_splits_and_odd_rows(spark, grid, part):
    rng = np.random.default_rng(grid)
    base = rng.standard_normal((40, 24))
    rows = []
    for k, b in enumerate(base):
        for c in range(rng.integers(1, 9) if k else 60):
            rows.append((1000 * k + c, (b + rng.normal(0, rng.choice([0, 0.05, 0.2, 0.35]), 24)).tolist()))
    rows += [(1, base[0].tolist()), (2, (3e100 * base[0]).tolist()), (3, (-base[0]).tolist()),
             (4, None), (5, []), (6, [0.0] * 24), (7, [float("nan")] * 24), (8, [None] + [1.0] * 23),
             (9, [float("inf")] * 24), (10, [1.0, 2.0]), (11, [2.0, 4.0]), (None, base[1].tolist()), (1, base[0].tolist())]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, node string")
    got = vectors.near_vectors(df, grid=grid, part_rows=part).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_vectors(df).count() == 0
