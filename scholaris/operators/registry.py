"""Surrogate keys that stay: a registry of the ids that have one.

Keys are handed out once. A load looks its ids up in the registry; those that are not there
are numbered densely after the greatest key in use and appended. So facts written on any
earlier day still point at the same members, whatever ids later loads bring, also in the
middle of the order.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholaris.operators.ranking import dense_key
from scholaris.sources.workspace import children

LOAD = "load"


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All entries so far, with the load that added them; none where there is no registry yet."""
    kind = f"{schema}, {LOAD} string"
    if not children(spark, path):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(path)


def newcomers(entries: DataFrame, rows: DataFrame, id_column: str, key: str) -> DataFrame:
    """(key, id) of the ids that the entries lack, numbered in the order of the ids.

    Repeated ids are one, null is no id. The ids are made distinct before they meet the
    registry, so an id of a third of all rows is one row a task there.
    """
    ids = rows.select(id_column).where(F.col(id_column).isNotNull()).distinct()
    fresh = ids.join(entries.select(id_column), id_column, "left_anti")
    last = entries.agg(F.coalesce(F.max(key), F.lit(0).cast("long"))).scalar()
    return dense_key(fresh, key, [id_column]).withColumn(key, F.col(key) + last)


def extend(rows: DataFrame, path: str, load: str, id_column: str, key: str) -> DataFrame:
    """Add the ids of a load to the registry at `path`; returns all its (id, key).

    The registry only grows: each load appends a folder of its own. A load that is run
    again finds its ids there and adds none. After a crash amid the writing, whatever part
    became visible counts as handed out, and the rest is numbered after it: keys may then
    have gaps, but none is given twice. Loads run one after another.
    """
    spark = rows.sparkSession
    schema = f"`{key}` long, `{id_column}` {rows.schema[id_column].dataType.simpleString()}"
    fresh = newcomers(read(spark, path, schema), rows, id_column, key)
    fresh.select(key, id_column).write.mode("append").parquet(f"{path}/{LOAD}={load}")
    return read(spark, path, schema).select(id_column, key)


def one_each(rows: DataFrame, id_column: str) -> DataFrame:
    """One row of each id that is not null: of repeated ids the least by the other columns, nulls first."""
    others = [c for c in rows.columns if c != id_column]
    least = F.min(F.struct(*others)).alias("__row")
    return rows.where(F.col(id_column).isNotNull()).groupBy(id_column).agg(least).select(id_column, "__row.*")


def keyed(rows: DataFrame, registry: DataFrame, id_column: str, key: str) -> DataFrame:
    """A dimension with keys that stay: one row of each registered id, the key as the first column."""
    return one_each(rows, id_column).join(registry, id_column).select(key, *rows.columns)
