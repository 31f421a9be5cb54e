"""Percentiles from quantile sketches that are stored once and merged on reading.

A sketch of a group's values is some kilobytes, whatever the group's size, and sketches of
loads or periods add up to one of all of them. A percentile read from it is a value whose
rank is off by `rank_error(k)` of the group's size at most, with 99 % confidence; groups of
fewer than k values are kept whole.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 2048


def rank_error(k: int = K) -> float:
    """Largest share by which a rank is off, at 99 % confidence: the bound published for these sketches."""
    return 2.296 / k**0.9723


def sketched(rows: DataFrame, groups: list[str], value: str, k: int = K) -> DataFrame:
    """(groups, sketch, n): sketches are built before the shuffle, so a group of a third of all rows is one row a task.

    Nulls and NaN are no values; a group of only those has no row.
    """
    values = rows.select(*groups, F.col(value).cast("double").alias("__value"))
    known = values.where(F.col("__value").isNotNull() & ~F.isnan("__value"))
    return known.groupBy(*groups).agg(F.kll_sketch_agg_double("__value", k).alias("sketch"), F.count("*").alias("n"))


def merged(stored: DataFrame, groups: list[str]) -> DataFrame:
    """One sketch a group from the sketches of its loads, or of finer groups."""
    return stored.groupBy(*groups).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))


def percentiles(stored: DataFrame, groups: list[str], percents: list[float]) -> DataFrame:
    """Percentiles as columns p<percent>, from one sketch a group."""
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100.0)).alias(f"p{p:g}") for p in percents]
    return stored.select(*groups, "n", *found)


def share_below(stored: DataFrame, groups: list[str], value) -> DataFrame:
    """(groups, share): the share of a group's values that are at most `value`."""
    return stored.select(*groups, F.kll_sketch_get_rank_double("sketch", F.lit(float(value))).alias("share"))
