"""Every registered query against its SQL counterpart on the small tables."""

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as entry_module
from oracle_queries import oracle
from tallymart.plans import catalog

QUERIES = {name: q for name, q in entry_module.queries().items() if name in catalog.QUERIES}
ORACLE = oracle()
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(catalog.QUERIES) == set(ORACLE)


def _sorted(rows, columns, order):
    index = [columns.index(c) for c in order]
    clean = (
        tuple(round(r[i], 9) + 0.0 if isinstance(r[i], float) else r[i] for i in index)
        for r in rows
    )
    return sorted(clean, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, str(DATA))
    theirs = duck.execute(ORACLE[name])
    columns = [d[0] for d in theirs.description]
    types = {d[0]: str(d[1]) for d in theirs.description}
    assert sorted(ours.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in ours.dtypes} == types
    order = sorted(columns)
    assert _sorted(ours.collect(), ours.columns, order) == _sorted(
        theirs.fetchall(), columns, order
    )


def test_entry(spark):
    first = entry_module.entry(spark).first()
    assert first["prev_month_revenue"] is None and first["net_revenue"] > 0
