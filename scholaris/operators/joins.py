"""Joins by group."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null: grouping keeps a null group, so the join does too."""
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(right, same, how).drop(*[f"__{k}" for k in keys])
