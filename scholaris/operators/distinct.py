"""Exact distinct counts over any span, from bitmaps that are stored once.

Dense keys, numbered from 1, are bits: the members of a period are a set of bitmaps of 32,768 keys
each, some four kilobytes. Sets of periods are merged by OR, so how many different members
a span of any length has is read from the bitmaps of its periods; the rows are not read.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

C = F.col


def bitmaps(rows: DataFrame, period: str, key: str) -> DataFrame:
    """(period, bucket, members): which keys each period has. Null keys are in none.

    Bits are set before the shuffle: a key on a third of all rows is one bit of each task.
    """
    bucket, bit = F.bitmap_bucket_number(key), F.bitmap_bit_position(key)
    known = rows.where(C(key).isNotNull())
    return known.groupBy(period, bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("members"))


def added(stored: DataFrame, more: DataFrame, period: str) -> DataFrame:
    """The bitmaps of both, where a later load brings further members of the same periods."""
    return stored.unionByName(more).groupBy(period, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def distinct_in_spans(stored: DataFrame, spans: DataFrame, period: str) -> DataFrame:
    """(first, last, members): the different members of each span of whole numbers, ends included.

    `spans` are as many rows as a report asks for; each is taken apart into its periods,
    which meet their bitmaps by equality. A span of none has 0 members.
    """
    wanted = spans.select("first", "last").distinct()
    periods = wanted.select("first", "last", F.explode(F.sequence("first", "last")).alias(period))
    merged = (
        stored.select(period, "bucket", "members")
        .join(periods, period)
        .groupBy("first", "last", "bucket")
        .agg(F.bitmap_or_agg("members").alias("members"))
    )
    counts = merged.groupBy("first", "last").agg(F.sum(F.bitmap_count("members")).alias("members"))
    zero = F.lit(0).cast("long")
    return wanted.join(counts, ["first", "last"], "left").withColumn("members", F.coalesce("members", zero))


def common_in_periods(stored: DataFrame, pairs: DataFrame, period: str) -> DataFrame:
    """(first, last, members): how many members are in both of two periods, such as those who returned."""
    wanted = pairs.select("first", "last").distinct()
    ends = wanted.select("first", "last", F.explode(F.array_distinct(F.array("first", "last"))).alias(period))
    both = (
        stored.select(period, "bucket", "members")
        .join(ends, period)
        .groupBy("first", "last", "bucket")
        .agg(F.bitmap_and_agg("members").alias("members"), F.count("*").alias("n"))
        .where(C("n") == F.when(C("first") == C("last"), 1).otherwise(2))
    )
    counts = both.groupBy("first", "last").agg(F.sum(F.bitmap_count("members")).alias("members"))
    zero = F.lit(0).cast("long")
    return wanted.join(counts, ["first", "last"], "left").withColumn("members", F.coalesce("members", zero))
