"""Positions and running totals over a whole table, without a one-task sort.

A window with no partition column, or with few distinct ones, sorts everything in a
handful of tasks. Here the rows are range-partitioned instead, so the sort is spread
evenly; each partition then starts from the total of the ones before it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholaris.sources.workspace import stored

# monotonically_increasing_id(): partition in the upper bits, row in the lower 33.
_ROW_BITS = 33
POSITION = ["__file", "__row"]


def positioned(df: DataFrame, in_files: bool = False) -> DataFrame:
    """Add each row's place in the files behind the frame, which tells copies apart.

    `in_files` says that the frame is a projection or filter of a parquet scan. Anything
    else, such as a join, has no row numbers of its own and is stored first.
    """
    df = df if in_files else stored(df, "rows")
    file, row = POSITION
    return df.select(
        "*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)
    )


def position_columns(df: DataFrame) -> list[str]:
    return [c for c in POSITION if c in df.columns]


def dense_key(df: DataFrame, name: str, order: list[str], again: str | None = None) -> DataFrame:
    """Number the rows 1..n in `order`, nulls first, as the first column.

    `again` names a last column, true where the row before has the same first column of
    `order`: rows of one key stand together, so that is every row but the key's first.

    Rows equal on all of `order` follow their position if the frame is `positioned`, so
    even a large group of identical rows spreads over many tasks; leave that out only
    where `order` is unique. One range shuffle and one write; no task sees more than
    its range.
    """
    columns = [c for c in df.columns if c not in POSITION]
    place = [F.col(c).asc_nulls_first() for c in order + position_columns(df)]
    ordered = (
        df.repartitionByRange(*place)
        .sortWithinPartitions(*place)
        .select(*columns, F.monotonically_increasing_id().alias("__place"))
    )
    ordered = stored(ordered, name)
    part = F.shiftright("__place", _ROW_BITS)
    row = F.col("__place").bitwiseAND((1 << _ROW_BITS) - 1)
    # One row per range partition, however large the table is.
    # Wrapped, so that a null key is something to compare with and no row is nothing.
    key = F.struct(F.col(order[0]).alias("key"))
    lasts = [F.max_by(key, "__place").alias("__last")] if again else []
    sizes = ordered.groupBy(part.alias("__part")).agg(F.count("*").alias("__size"), *lasts)
    in_order = Window.orderBy("__part")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    starts = [F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")]
    parts = ordered.withColumn("__part", part)
    if again:
        starts.append(F.lag("__last").over(in_order).alias("__last"))
        # Ranges are of one size: dealt in their order, every task has as many rows, and the window
        # below is content with that. A hash of so few numbers would put several into one task.
        parts = parts.repartitionByRange("__part")
    numbered = parts.join(F.broadcast(sizes.select("__part", *starts)), "__part")
    flags = []
    if again:
        # The row before in the same range, or the last of the range before.
        previous = F.lag(key).over(Window.partitionBy("__part").orderBy("__place"))
        flags = [F.coalesce(key == F.coalesce(previous, F.col("__last")), F.lit(False)).alias(again)]
    return numbered.select((F.col("__start") + row + 1).alias(name), *columns, *flags)


def running_total(df: DataFrame, group: str, order: str, weight: str, name: str, total: str) -> DataFrame:
    """Add, within `group`, the sum of `weight` up to each row in `order`, and over all rows.

    (group, order) must be unique: aggregate first. A group that holds most of the
    table is split over range partitions like everything else.
    """
    place = [F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first()]
    ranged = stored(
        df.repartitionByRange(*place).withColumn("__part", F.spark_partition_id()), "ranged"
    )
    # One row per range partition and group in it.
    slices = ranged.groupBy("__part", group).agg(F.sum(weight).alias("__slice"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select(
        F.col("__part").alias("__p"),
        F.col(group).alias("__g"),
        F.coalesce(F.sum("__slice").over(before), F.lit(0)).alias("__start"),
        F.sum("__slice").over(whole).alias(total),
    )
    inside = Window.partitionBy("__part", group).orderBy(F.col(order).asc_nulls_first())
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.withColumn("__inside", F.sum(weight).over(inside))
        .join(starts, (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")))
        .withColumn(name, F.col("__start") + F.col("__inside"))
        .drop("__part", "__inside", "__p", "__g", "__start")
    )


def value_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n), values without nulls."""
    return df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))


def percentiles(df: DataFrame, group: str, value: str, percents: list[float], exact: bool = True) -> DataFrame:
    """Percentiles per group as columns p<percent>, with linear interpolation; 0 without values.

    Exact results come from value counts and their running totals: each percentile
    reads the one or two values whose counts cover its rank. `exact=False` uses a
    sketch that never needs the second shuffle.
    """
    names = [f"p{p:g}" for p in percents]
    if not exact:
        return df.groupBy(group).agg(
            *[
                F.coalesce(F.percentile_approx(value, p / 100.0, 10_000).cast("double"), F.lit(0.0)).alias(n)
                for n, p in zip(names, percents)
            ]
        )
    # Null is a value that counts nothing, so that a group of only nulls stays a group.
    counts = df.groupBy(group, value).agg(F.count(value).alias("n"))
    ranked = running_total(counts, group, value, "n", "__upto", "__size")

    def at(rank: Column) -> Column:
        covers = (F.col("__upto") > rank) & (F.col("__upto") - F.col("n") <= rank)
        return F.max(F.when(covers, F.col(value).cast("double")))

    result = []
    for name, p in zip(names, percents):
        spot = F.lit(p / 100.0) * (F.col("__size") - 1)
        low, high = at(F.floor(spot)), at(F.ceil(spot))
        share = F.max(spot - F.floor(spot))
        result.append(F.coalesce(low + (high - low) * share, F.lit(0.0)).alias(name))
    return ranked.groupBy(group).agg(*result)


def percent_rank(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """(group, value, name): share of the group's other rows that rank below each value."""
    ranked = running_total(value_counts(df, group, value), group, value, "n", "__upto", "__size")
    below = F.col("__upto") - F.col("n")
    others = F.nullif(F.col("__size") - 1, F.lit(0))
    return ranked.select(group, value, F.coalesce(below / others, F.lit(0.0)).alias(name))
