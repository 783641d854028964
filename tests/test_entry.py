import math

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

# Queries without a SQL counterpart, each checked against brute force in its own test.
ROWS_ONLY = {"rouge_l_documents", "rouge_resample"}

# The library's own queries; a subpackage that adds more tests them itself.
OWN = {name for area in contract.AREAS for name in area.QUERIES}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{small}/{name}.parquet'")
    return con


def canonical(rows, order):
    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return str(v)

    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 1


def test_only_the_listed_queries_lack_sql():
    assert OWN - set(contract.oracle_sql()) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert OWN <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_its_sql(spark, duck, small, name):
    df = contract.queries()[name](spark, small)
    names = df.columns
    rows = df.collect()
    if name in ROWS_ONLY:
        assert rows
        return
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(names) == sorted(relation.columns)
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {n: SQL_TYPES[t] for n, t in df.dtypes} == types
    shared = sorted(names)
    got = canonical(rows, [names.index(n) for n in shared])
    assert got == canonical(relation.fetchall(), [relation.columns.index(n) for n in shared])
