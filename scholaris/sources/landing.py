"""A landing zone in folders by day: rows are appended, and leave by whole days.

What landed on a day is a folder of its own, so retention needs no pass over what it
keeps: folders of days that are over go, and only the day that the limit falls into is
written anew. Every other file stays the one it was.
"""

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholaris.sources.workspace import children, delete_folder, replace_folder

DAY = "landed_on"
# Readers pass over names that begin with an underscore.
_REWRITTEN = "_rewritten"


def land(rows: DataFrame, path: str, timestamp: str) -> None:
    """Append rows to the folders of the days of their `timestamp`; rows without one have a folder too.

    The range shuffle gives a day as many files as its share of the rows asks for.
    """
    finish(rows.sparkSession, path)
    dated = rows.withColumn(DAY, F.to_date(timestamp))
    dated.repartitionByRange(DAY, timestamp, *[c for c in rows.columns if c != timestamp]).write.mode("append").partitionBy(DAY).parquet(path)


def days(spark: SparkSession, path: str) -> list[str]:
    """Days that something lies in, as yyyy-mm-dd, from the names of the folders alone."""
    return [name.removeprefix(f"{DAY}=") for name in children(spark, path) if re.fullmatch(rf"{DAY}=\d{{4,}}-\d\d-\d\d", name)]


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows that landed, in the columns they came with."""
    names = [field.name for field in schema.fields]
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*names) if children(spark, path) else spark.createDataFrame([], schema)


def finish(spark: SparkSession, path: str) -> None:
    """Put days in place that a purge had written down anew before it broke off.

    A rewritten day is whole once Spark has marked its folder; one that is not goes.
    """
    for name in children(spark, f"{path}/{_REWRITTEN}"):
        anew = f"{path}/{_REWRITTEN}/{name}"
        if "_SUCCESS" in children(spark, anew):
            replace_folder(spark, anew, f"{path}/{name}")
        else:
            delete_folder(spark, anew)


def purge(spark: SparkSession, path: str, schema, timestamp: str, as_of: datetime, keep_days: int) -> dict[str, int]:
    """Drop what is older than `keep_days` at `as_of`; rows without a timestamp stay.

    Returns how many folders were dropped and rewritten. Days that ended before the limit
    are deleted unread. The day of the limit, if it holds an older row, is written anew
    beside the others and then put in its place; days after it are not touched. A purge
    that breaks off loses no row that is kept: the next purge or landing finishes it.
    Landings and purges of one path run one after another.
    """
    finish(spark, path)
    limit = as_of - timedelta(days=keep_days)
    there, boundary = days(spark, path), limit.date().isoformat()
    over = [day for day in there if datetime.fromisoformat(day).date() < limit.date()]
    for day in over:
        delete_folder(spark, f"{path}/{DAY}={day}")
    rewritten = 0
    if boundary in there:
        rows = spark.read.schema(schema).parquet(f"{path}/{DAY}={boundary}")
        young = F.col(timestamp) >= F.lit(limit.isoformat(sep=" ")).cast(schema[timestamp].dataType)
        if not rows.where(~young).isEmpty():
            rows.where(young).write.mode("overwrite").parquet(f"{path}/{_REWRITTEN}/{DAY}={boundary}")
            finish(spark, path)
            rewritten = 1
    return {"dropped": len(over), "rewritten": rewritten}
