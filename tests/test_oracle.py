"""Every registered query against its SQL in DuckDB, on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from zonewright.plans import catalog_layouts, catalog_reports, catalog_search, catalog_sources, catalog_updates

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


OWN = {name for catalog in (catalog_layouts, catalog_reports, catalog_search, catalog_sources, catalog_updates) for name in catalog.QUERIES}


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) >= OWN


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted(tuple(_plain(x) for x in r) for r in df.select(*cols).collect())
    result = duck.execute(entry.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    order = [d[0] for d in result.description]
    theirs = sorted(tuple(_plain(row[order.index(c)]) for c in cols) for row in result.fetchall())
    assert sorted(order) == cols
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert mine == theirs


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows == sorted(rows, key=lambda r: (-r["visits_12m"], r["domain"]))
