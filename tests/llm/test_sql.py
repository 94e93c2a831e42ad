"""Queries of the training-data operators against their SQL, on the smallest driver tables."""

import os

import duckdb
import pytest

from zonewright.llm import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.execute(catalog.ORACLES[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    df = catalog.QUERIES[name](spark, SF).select(*kinds)
    mine = sorted(repr(tuple(r)) for r in df.collect())
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert mine == sorted(repr(r) for r in result.fetchall()) and mine
