"""Every registered query against its DuckDB oracle on the same tables."""

import pytest

from table_folders import ORACLE_SF

import __spark_entry__ as entry
from playstats.plans.catalog import CATALOG
from playstats.plans.compare import compare_frames, duck_connection

QUERIES = {name: q for name, q in entry.queries().items() if name in CATALOG}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in CATALOG}


@pytest.fixture(scope="module")
def con():
    return duck_connection(ORACLE_SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, ORACLE_SF)
    assert compare_frames(df, con, ORACLE[name]) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["gender", "n_plays", "n_users", "unique_count"]
    assert df.count() >= 0


DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


def _duck_type(t):
    s = t.simpleString()
    if s.startswith("array<"):
        return DUCK_TYPES.get(s[6:-1], s[6:-1]) + "[]"
    return DUCK_TYPES.get(s, s)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, con, name):
    spark_types = {f.name: _duck_type(f.dataType) for f in QUERIES[name](spark, ORACLE_SF).schema.fields}
    rel = con.sql(ORACLE[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
