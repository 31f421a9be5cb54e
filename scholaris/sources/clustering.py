"""Files clustered on several columns at once.

Sorting by one column leaves every file with all values of the others. Here each column is
ranked into ranges of like numbers of rows, and the bits of the ranks are interleaved: rows
that are near on all columns lie near in the files, so that the footers' least and greatest
values rule out most row groups for a filter on any of them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaris.sources.files import saved

# Ranges of a column are 2**BITS; bounds come from about SAMPLE rows for each column.
BITS = 6
SAMPLE = 20_000


def bounds(df: DataFrame, columns: list[str], bits: int = BITS, sample: int = SAMPLE) -> dict[str, list]:
    """Upper ends of the ranges of each column, from a sample of bounded size.

    Rows are drawn in one pass by a hash of their values and place, the least first; nulls
    are below all ranges. The bounds shape the files, never the result.
    """
    drawn = df.select(*columns, F.xxhash64(*columns, F.monotonically_increasing_id()).alias("__drawn"))
    rows = drawn.orderBy("__drawn").limit(sample).collect()
    found = {}
    for place, name in enumerate(columns):
        values = sorted(r[place] for r in rows if r[place] is not None)
        found[name] = sorted({values[len(values) * i >> bits] for i in range(1, 1 << bits)}) if values else []
    return found


def rank(column: str, ends: list) -> Column:
    """The number of ends that a value reaches, found by halving: a tree of comparisons."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(column) < F.lit(ends[middle]), between(low, middle)).otherwise(between(middle + 1, high))

    return F.when(F.col(column).isNull(), 0).otherwise(between(0, len(ends))).cast("int")


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """One number of the ranks' bits, the highest of each first."""
    found = F.lit(0)
    for bit in range(bits):
        for place, one in enumerate(ranks):
            to = bit * len(ranks) + len(ranks) - 1 - place
            found = found.bitwiseOR(F.shiftleft(F.shiftright(one, bit).bitwiseAND(1), to))
    return found


def write_clustered(df: DataFrame, path: str, columns: list[str], by: str | None = None, bits: int = BITS) -> int:
    """Write a table so that a filter on any of `columns` reads few of its row groups; returns the rows.

    `by` adds a folder for each of its values, inside which rows are clustered. The range
    shuffle on the interleaved ranks, and on all columns where these are equal, gives tasks
    equal shares even if one value has a third of all rows; rows that are equal throughout
    cannot be told apart and stay together.
    """
    ends = bounds(df, columns, bits)
    place = interleaved([rank(c, ends[c]) for c in columns], bits).alias("__place")
    rest = [c for c in df.columns if c not in columns and c != by]
    order = [*([by] if by else []), "__place", *columns, *rest]
    placed = df.select("*", place).repartitionByRange(*order).sortWithinPartitions(*order)
    return saved(placed.drop("__place"), path, by)[1]
