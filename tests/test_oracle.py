"""Every query against its DuckDB SQL, exactly: names, types and values."""

import os

import __spark_entry__
import pytest
from compare import connect, difference

from scholaris.plans.catalog import ORACLE, QUERIES
from scholaris.sources.workspace import clear_workspace

DIRECTORY = f"/root/testdata/{os.environ.get('ORACLE_SF', 'sf0.01')}"


@pytest.fixture(scope="module")
def duck():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, name):
    result = QUERIES[name](spark, DIRECTORY)
    assert difference(result, duck, ORACLE[name]) is None
    clear_workspace(spark)


def test_every_query_is_registered_and_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE) <= set(__spark_entry__.oracle_sql())


def test_entry_is_the_flagship(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["major", "academic_year", "total_enrollments", "avg_gpa"]
    assert df.count() > 0
