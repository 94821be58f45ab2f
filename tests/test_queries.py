"""Every registered query against its DuckDB oracle on sf0.001 (rows, names, types, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from cohortac.oracle_queries import ORACLES
from cohortac.queries import QUERIES
from helpers import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["region", "contig", "pos", "ref", "alt"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    ocols, otypes, orows = list(rel.columns), [str(t) for t in rel.types], rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    stypes = dict(df.dtypes)
    assert [TYPE_MAP.get(stypes[c], stypes[c]) for c in ocols] == otypes
    assert canon(df.columns, rows) == canon(ocols, orows)
