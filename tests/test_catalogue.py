"""Every catalogue query with an oracle gives DuckDB's rows."""

import math
import os

import pytest

from quern.plans import catalogue

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations "
    "clicks sales sale_lines clients client_changes vendors items stamps"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(found, columns):
    def key(v):
        return (v is None, f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v))

    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(key(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_sql(spark, db, name):
    df = catalogue.QUERIES[name](spark, SF)
    rel = db.sql(catalogue.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.collect(), df.columns) == rows(rel.fetchall(), rel.columns)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["organisation_number", "name", "municipality", "employees", "revenue"]
