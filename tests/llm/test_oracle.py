"""Queries of this subpackage against their DuckDB SQL, and the SQL on planted rows."""

import duckdb
import pytest

from larch.llm.queries import ORACLE, QUERIES

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, detail, _, _ = compare(spark, duck(SF_SMALL), name, SF_SMALL, QUERIES[name], ORACLE[name])
    assert ok, detail


def test_planted_links_and_components(spark, tmp_dir):
    """The given vectors hold no link: three planted chains do."""
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.3]), (3, [1.0, 0.6]), (4, [-1.0, 0.0]), (5, [-2.0, 0.1]), (6, [0.0, 0.0]),
            (7, None), (8, [0.0, float("nan")])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_dir}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_dir}/embeddings.parquet/*.parquet'")
    want = sorted(con.sql(ORACLE["op6_subspace_join"]).fetchall())
    got = QUERIES["op6_subspace_join"](spark, tmp_dir).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, got.collect())) == want
    assert [(r[0], r[1], r[2]) for r in want][:5] == [(1, 1, 1), (2, 2, 1), (3, 1, 1), (4, 1, 4), (5, 1, 4)]
