"""The registered queries of this package against their DuckDB oracles."""

from __future__ import annotations

import duckdb
import pytest

from medallion.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    rel = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in rel.description]
    want = sorted(map(str, rel.fetchall()))
    assert sorted(got.columns) == sorted(names)
    assert sorted(str(tuple(r)) for r in got.select(*names).collect()) == want
