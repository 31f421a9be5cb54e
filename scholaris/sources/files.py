"""Files in and out: typed CSV, staging loads, partitioned tables, retention and logs."""

from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scholaris.functions.numeric import without_nan
from scholaris.operators.integrity import row_counts
from scholaris.schemas import STAGING
from scholaris.sources.workspace import together

C = F.col


# Quotes inside a value are doubled, and blanks at its ends are part of it.
CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).csv(path)


def write_lines(lines: DataFrame, path: str, header: str) -> None:
    """Text files of the lines in `value`, each with a header line: what a source system drops in an inbox."""
    file = F.spark_partition_id().alias("file")
    numbered = lines.select("value", file, F.monotonically_increasing_id().alias("at"))
    heads = numbered.groupBy("file").agg(F.lit(header).alias("value"), F.lit(-1).cast("long").alias("at"))
    ordered = numbered.unionByName(heads.select("value", "file", "at")).repartition("file").sortWithinPartitions("file", "at")
    ordered.select("value", "file").write.mode("overwrite").partitionBy("file").text(path)


def read_csv(spark: SparkSession, table: str, path: str, multiline: bool = False) -> DataFrame:
    """A staging table from CSV with its declared types; a malformed value is an error.

    `multiline` allows line breaks inside values, at the price of one task per file.
    """
    reader = spark.read.schema(STAGING[table]).options(**CSV, mode="FAILFAST", multiLine=multiline)
    return reader.csv(path)


def with_load_timestamp(df: DataFrame, at: datetime | Column | None = None) -> DataFrame:
    """Add the time of loading: `at`, or the start of the query that loads."""
    if isinstance(at, datetime):
        at = F.lit(at).cast("timestamp")
    return df.withColumn("load_timestamp", F.current_timestamp() if at is None else at)


def saved(df: DataFrame, path: str, by: str | list[str] | None = None) -> tuple[DataFrame, int]:
    """Write a table, in folders for the values of `by` if given; returns it as written, and its rows.

    The rows are counted as they are written, in the last stage, where Spark counts a task
    once however often it was tried; what is written is not read for it.
    """
    rows = Observation()
    writer = df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    (writer.partitionBy(*_listed(by)) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), int(rows.get.get("rows", 0))


def load_counted(tables: dict[str, DataFrame], directory: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Replace each staging table; returns the tables as written, with NaN as null, and their rows.

    All are written at the same time, small tables beside the large ones.
    """
    done = together({name: partial(saved, with_load_timestamp(without_nan(df)), f"{directory}/{name}") for name, df in tables.items()})
    return {name: df for name, (df, _) in done.items()}, {name: rows for name, (_, rows) in done.items()}


def load_staging(tables: dict[str, DataFrame], directory: str) -> dict[str, DataFrame]:
    """Replace each staging table and return it as written, with NaN as null."""
    return load_counted(tables, directory)[0]


def extraction_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, and of all tables on the row `all`."""
    counts = row_counts(tables)
    total = counts.agg(F.sum("row_count").alias("row_count"))
    return counts.unionByName(total.withColumn("table_name", F.lit("all")))


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make frames known to SQL by name, replacing earlier ones of that name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def table_row_count(spark: SparkSession, table: str) -> int:
    return spark.table(table).count()


def run_query(spark: SparkSession, sql: str, max_results: int | None = None, **tables: DataFrame) -> DataFrame:
    """Result of a SQL text, whole unless cut to `max_results`; order in the text for a stable cut.

    Frames passed by name stand in the text as {name}.
    """
    result = spark.sql(sql, **tables)
    return result if max_results is None else result.limit(max_results)


def _listed(columns: str | list[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def write_partitioned(df: DataFrame, path: str, by: str | list[str], sort: list[str]) -> int:
    """Folders for the values of `by`, one column inside another, sorted across and inside their files; returns the rows.

    The range shuffle gives every task an equal share: a value that holds most of the
    table gets many files, provided that `sort` tells its rows apart.
    """
    place = [*_listed(by), *sort]
    ordered = df.repartitionByRange(*place).sortWithinPartitions(*place)
    return saved(ordered, path, by)[1]


def refresh_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace only the values of `by` that occur in `df`; the rest of the table stays.

    The range shuffle gives a value as many files as its share of the rows asks for,
    instead of one from every task.
    """
    (
        df.repartitionByRange(by, *[c for c in df.columns if c != by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def kept(df: DataFrame, timestamp: str, as_of: Column, days: int) -> DataFrame:
    """Rows not older than `days` at `as_of`; rows without a timestamp stay."""
    return df.filter(C(timestamp).isNull() | (C(timestamp) >= as_of - F.make_dt_interval(F.lit(days))))


def purge(df: DataFrame, path: str, timestamp: str, as_of: Column, days: int) -> DataFrame:
    """Write what retention keeps to `path` and return it."""
    left = kept(df, timestamp, as_of, days)
    left.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
