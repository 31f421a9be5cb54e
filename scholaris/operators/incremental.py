"""Summaries that are kept up to date from what changed.

A group's state is a handful of sums: rows, values, their sum and the sum of their squares.
States add up, and a row that is gone is a row of weight -1, so the state after a load is
the state before it plus the state of the change feed. Sums are decimals: adding and taking
away leaves exactly what a new count would give, in any order.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.functions.numeric import ratio

C = F.col
WEIGHT = "weight"
KINDS = {"n": "long", "counted": "long", "total": "decimal(38,6)", "squares": "decimal(38,12)"}
# Values are taken to this many decimal places.
PLACES = 6


def change_feed(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows of two loads that differ, with `weight`: how many copies came or, below 0, went.

    A changed row is its old version with -1 and its new one with 1. Rows are compared as a
    whole, so a table needs no key, and repeated rows count as often as they stand there.
    Copies are added up before the shuffle: a third of all rows in one row is one a task.
    """
    columns = after.columns
    both = before.select(*columns, F.lit(-1).cast("long").alias(WEIGHT)).unionByName(
        after.select(*columns, F.lit(1).cast("long").alias(WEIGHT))
    )
    return both.groupBy(*columns).agg(F.sum(WEIGHT).alias(WEIGHT)).where(C(WEIGHT) != 0)


def states(rows: DataFrame, groups: list[str], value: str) -> DataFrame:
    """The state of each group. Rows count by their `weight` if they have one; null values count as rows alone."""
    weight = C(WEIGHT) if WEIGHT in rows.columns else F.lit(1).cast("long")
    x, w = C(value).cast(f"decimal(18,{PLACES})"), weight.cast("decimal(10,0)")
    return rows.groupBy(*groups).agg(
        F.sum(weight).alias("n"),
        F.coalesce(F.sum(F.when(C(value).isNotNull(), weight)), F.lit(0).cast("long")).alias("counted"),
        F.coalesce(F.sum(x * w), F.lit(0)).cast("decimal(38,6)").alias("total"),
        F.coalesce(F.sum((x * x).cast("decimal(28,12)") * w), F.lit(0)).cast("decimal(38,12)").alias("squares"),
    )


def _added(parts: list[DataFrame], groups: list[str]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*groups).agg(*[F.sum(c).cast(KINDS[c]).alias(c) for c in KINDS])


def merged(parts: list[DataFrame], groups: list[str]) -> DataFrame:
    """One state a group from the states of parts of a table."""
    return _added(parts, groups).where(C("n") > 0)


def refreshed(summary: DataFrame, feed: DataFrame, groups: list[str], value: str) -> DataFrame:
    """The states after a change feed, from the states before it and the feed alone.

    Groups that nothing is left of are gone. A feed that takes away more than there was is
    an error: it does not belong to this summary, or was applied before.
    """
    sums = _added([summary, states(feed, groups, value)], groups)
    message = F.concat(F.lit("more rows went than there were: "), F.to_json(F.struct(*groups)))
    return sums.where(F.when(C("n") >= 0, C("n") > 0).otherwise(F.raise_error(message).cast("boolean")))


def summarized(states_: DataFrame, groups: list[str], digits: int = 6) -> DataFrame:
    """(groups, total_enrollments, avg_gpa, sd_gpa): rows, mean and sample deviation from the states."""
    mean = ratio("total", "counted")
    spread = C("squares").cast("double") - C("total").cast("double") * mean
    deviation = F.sqrt(ratio(F.greatest(spread, F.lit(0.0)), C("counted") - 1))
    return states_.select(
        *groups,
        C("n").alias("total_enrollments"),
        F.round(ratio("total", "counted"), digits).alias("avg_gpa"),
        F.round(deviation, digits).alias("sd_gpa"),
    )
