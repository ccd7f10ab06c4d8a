"""Queries against their DuckDB SQL, and the registry as the driver sees it."""

import pytest

import __spark_entry__ as entry
from playstats.llm.registry import QUERIES, SQL
from playstats.plans.compare import compare_frames, duck_connection

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    assert compare_frames(QUERIES[name](spark, FOLDER), duck_connection(FOLDER), SQL[name]) == []


def test_all_are_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in entry.queries() if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(SQL) <= set(entry.oracle_sql())
