"""Summaries after change feeds against summaries of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from scholaris.operators.incremental import change_feed, merged, refreshed, states, summarized
from scholaris.sources.workspace import stored

GROUPS, SCHEMA = ["major", "year"], "id long, major string, year long, points double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def whole(df):
    return df.groupBy(*GROUPS).agg(
        F.count("*").alias("total_enrollments"), F.round(F.avg("points"), 6).alias("avg_gpa"), F.round(F.stddev_samp("points"), 6).alias("sd_gpa")
    )


def rows(df):
    return sorted(map(repr, map(tuple, df.select(*GROUPS, "total_enrollments", "avg_gpa", "sd_gpa").collect())))


def drawn(rng, n):
    return [
        (rng.randint(0, 60), rng.choice(["A", "B", None]), rng.choice([2020, 2021, None]), rng.choice([None, round(rng.random() * 4, 2)]))
        for _ in range(n)
    ]


def test_many_loads(spark):
    """Inserts, changes, deletes and repeated rows, load after load."""
    rng = random.Random(9)
    before = drawn(rng, 80)
    summary = stored(states(frame(spark, before), GROUPS, "points"), "s")
    for _ in range(3):
        after = [r for r in before if rng.random() < 0.7] + drawn(rng, 20) + before[:5]
        after = [(i, m, y, None if p is None else round(p + 0.1, 2)) if rng.random() < 0.2 else (i, m, y, p) for i, m, y, p in after]
        feed = change_feed(frame(spark, before), frame(spark, after))
        summary = stored(refreshed(summary, feed, GROUPS, "points"), "s")
        assert rows(summarized(summary, GROUPS)) == rows(whole(frame(spark, after)))
        before = after
    gone = refreshed(summary, change_feed(frame(spark, before), frame(spark, [])), GROUPS, "points")
    assert gone.count() == 0


def test_feed_counts_copies(spark):
    a, b, c = (1, "A", 2020, 1.0), (2, "A", 2020, None), (3, None, None, None)
    feed = change_feed(frame(spark, [a, a, a, b, c]), frame(spark, [a, b, b, c]))
    assert sorted((r.id, r.weight) for r in feed.collect()) == [(1, -2), (2, 1)]


def test_sums_do_not_drift(spark):
    """What is added and taken away a thousand times leaves exactly what was there."""
    base = [(i, "A", 2020, 0.1 * i) for i in range(5)]
    summary = states(frame(spark, base), GROUPS, "points")
    noise = [(i, "A", 2020, 1e6 / (i + 3)) for i in range(1000)]
    moved = merged([summary, states(frame(spark, noise), GROUPS, "points")], GROUPS)
    back = refreshed(moved, frame(spark, noise).withColumn("weight", F.lit(-1).cast("long")), GROUPS, "points")
    assert back.collect() == merged([summary], GROUPS).collect()


def test_parts_merge_in_any_order(spark):
    rng = random.Random(2)
    parts = [drawn(rng, 30) for _ in range(3)]
    each = [states(frame(spark, p), GROUPS, "points") for p in parts]
    one, other = merged(each, GROUPS), merged(each[::-1], GROUPS)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
    assert rows(summarized(one, GROUPS)) == rows(whole(frame(spark, [r for p in parts for r in p])))


def test_a_feed_of_another_summary_is_an_error(spark):
    summary = states(frame(spark, [(1, "A", 2020, 1.0)]), GROUPS, "points")
    feed = change_feed(frame(spark, [(1, "A", 2020, 1.0), (2, "A", 2020, 1.0)]), frame(spark, []))
    with pytest.raises(Exception, match="more rows went than there were"):
        refreshed(summary, feed, GROUPS, "points").collect()


def test_the_merge_reads_the_summary_and_the_feed_only(spark):
    before, after = frame(spark, drawn(random.Random(1), 50)), frame(spark, drawn(random.Random(2), 50))
    stored(before, "facts")
    summary, feed = stored(states(before, GROUPS, "points"), "s"), stored(change_feed(before, after), "feed")
    read = refreshed(summary, feed, GROUPS, "points").inputFiles()
    assert set(read) == set(summary.inputFiles()) | set(feed.inputFiles())
