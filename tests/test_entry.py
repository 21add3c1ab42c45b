"""Every registered query that has a DuckDB oracle against it on the smallest tables, columns and all; the entry module's
contract."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from benchlake import queries as catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool) or v is None:
        return str(v)
    return "None" if isinstance(v, float) and math.isnan(v) else f"{v:.6g}" if isinstance(v, int | float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted({*catalogue.queries(), *entry.oracle_sql()}))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted([plain(r[c]) for c in columns] for r in df.collect())
    if name not in entry.oracle_sql():
        assert got
        return
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    assert got == sorted([plain(r[names.index(c)]) for c in columns] for r in cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(catalogue.queries()) <= set(entry.queries())
