"""Distinct members of spans from bitmaps, against counts over the rows."""

import random

import pytest

from scholaris.operators.distinct import added, bitmaps, common_in_periods, distinct_in_spans
from scholaris.sources.workspace import stored

SPANS = [(2010, 2012), (2010, 2019), (2015, 2015), (1990, 1991), (2019, 2030)]


def drawn(n, seed):
    rng = random.Random(seed)
    keys = [1, 2, 32_767, 32_768, 32_769, 65_536, 65_537, 1_000_000]
    return [(rng.choice([2010, 2011, 2012, 2015, 2019]), rng.choice([None, 7, rng.choice(keys), rng.randint(1, 200_000)])) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "year long, k long")


@pytest.fixture(scope="module")
def rows():
    return drawn(4000, 1)


def spans(spark, pairs):
    return spark.createDataFrame(pairs, "first long, last long")


def test_spans(spark, rows):
    found = distinct_in_spans(stored(bitmaps(frame(spark, rows), "year", "k"), "b"), spans(spark, [*SPANS, SPANS[0]]), "year").collect()
    expected = {(a, b): len({k for y, k in rows if a <= y <= b and k is not None}) for a, b in SPANS}
    assert {(r.first, r.last): r.members for r in found} == expected and len(found) == len(SPANS)


def test_loads_add_up(spark, rows):
    more = drawn(1000, 2)
    both = added(bitmaps(frame(spark, rows), "year", "k"), bitmaps(frame(spark, more), "year", "k"), "year")
    found = distinct_in_spans(both, spans(spark, SPANS), "year").collect()
    assert {(r.first, r.last): r.members for r in found} == {
        (a, b): len({k for y, k in rows + more if a <= y <= b and k is not None}) for a, b in SPANS
    }


def test_members_of_both_periods(spark, rows):
    pairs = [(2010, 2011), (2011, 2019), (2010, 2010), (2010, 1999), (1999, 1999)]
    found = common_in_periods(bitmaps(frame(spark, rows), "year", "k"), spans(spark, pairs), "year").collect()
    of = {y: {k for z, k in rows if z == y and k is not None} for y in (2010, 2011, 2019, 1999)}
    assert {(r.first, r.last): r.members for r in found} == {(a, b): len(of[a] & of[b]) for a, b in pairs}


def test_counts_read_the_bitmaps_only(spark, rows):
    facts = stored(frame(spark, rows), "facts")
    bits = stored(bitmaps(facts, "year", "k"), "bits")
    counted = distinct_in_spans(bits, spans(spark, SPANS), "year")
    assert set(counted.inputFiles()) == set(bits.inputFiles())
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_rows(spark):
    found = distinct_in_spans(bitmaps(frame(spark, []), "year", "k"), spans(spark, SPANS[:1]), "year").collect()
    assert [r.members for r in found] == [0]
