"""The registered queries on whole small tables: against SQL where there is some, and their plans."""

import duckdb
import pytest

from scholaris.llm.queries import ORACLE, QUERIES

DIRECTORY = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connection():
    found = duckdb.connect()
    for name in TABLES:
        found.execute(f"create view {name} as select * from '{DIRECTORY}/{name}.parquet'")
    return found


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    frame = QUERIES[name](spark, DIRECTORY)
    answer = connection().execute(ORACLE[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = sorted(map(repr, answer.fetchall()))
    assert sorted(repr(tuple(r)) for r in frame.select(*columns).collect()) == expected and expected


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    plan = QUERIES[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
