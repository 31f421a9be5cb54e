"""Loading CSV with the bad lines set aside instead of ending the load.

A line is bad where the strict reader would stop: a value that is not of its declared type,
or too many or too few values. Good rows go on; bad lines are kept as they were, with
their file and what is wrong with them, and their share is held against a limit.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholaris.schemas import STAGING
from scholaris.sources.files import CSV, saved
from scholaris.sources.workspace import stored

LINE = "_bad_line"
# Largest share of bad lines that a load goes on with.
MOST = 0.01


class QuarantineError(RuntimeError):
    """Raised where too many lines of a load are bad."""


@dataclass(frozen=True)
class Checked:
    """A read table: its good rows, its bad lines, and how many there are of either."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int

    @property
    def share(self) -> float:
        return self.n_bad / max(self.n_good + self.n_bad, 1)


def _faults(schema: T.StructType) -> Column:
    """What is wrong with a bad line: the columns whose values are not of their types."""
    plain = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(LINE, T.StringType())])
    options = {**{k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV.items() if k != "header"}, "columnNameOfCorruptRecord": LINE}
    values = F.from_csv(F.col(LINE), F.lit(plain.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")), options)
    each = [
        F.when(
            values[f.name].isNotNull() & values[f.name].try_cast(f.dataType).isNull(),
            F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), values[f.name]),
        )
        for f in schema
        if not isinstance(f.dataType, T.StringType)
    ]
    found = F.array_compact(F.array(*each))
    return (
        F.when(values[LINE].isNotNull(), F.array(F.lit(f"not {len(schema)} values")))
        .when(F.size(found) > 0, found)
        .otherwise(F.array(F.lit("unreadable")))
    )


def read_checked(spark: SparkSession, table: str, path: str, multiline: bool = False) -> Checked:
    """A staging table from CSV, its bad lines apart as (file, line, faults array<string>).

    The files are read once, every column of every line, and written down; both parts are
    read from there. An empty file has neither.
    """
    schema = STAGING[table]
    marked = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    # Pruned columns would not be parsed, and their faults not seen.
    options = {**CSV, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE, "columnPruning": False, "multiLine": multiline}
    rows = spark.read.schema(marked).options(**options).csv(path)
    landed = stored(rows.select("*", F.col("_metadata.file_path").alias("_file")), f"checked-{table}")
    good = landed.where(F.col(LINE).isNull()).select(schema.names)
    bad = landed.where(F.col(LINE).isNotNull()).select(F.col("_file").alias("file"), F.col(LINE).alias("line"), _faults(schema).alias("faults"))
    counts = landed.agg(F.count("*").alias("n"), F.count(LINE).alias("bad")).first()
    return Checked(good, bad, counts["n"] - counts["bad"], counts["bad"])


def extract(
    spark: SparkSession, paths: dict[str, str], directory: str, run_id: str, most: float = MOST, multiline: bool = False
) -> dict[str, DataFrame]:
    """The good rows of all tables, ready for a run; bad lines go to `directory`/quarantine first.

    They are written for every table, in a folder of the run, before any share is judged:
    where one is over `most`, the load ends with the evidence at hand.
    """
    checked = {table: read_checked(spark, table, path, multiline) for table, path in paths.items()}
    for table, found in checked.items():
        if found.n_bad:
            lines = found.bad.select(F.lit(table).alias("table_name"), "file", "line", "faults", F.current_timestamp().alias("set_aside_at"))
            saved(lines, f"{directory}/quarantine/run_id={run_id}/{table}")
    over = {table: found for table, found in checked.items() if found.share > most}
    if over:
        told = ", ".join(f"{table} {found.n_bad} of {found.n_bad + found.n_good}" for table, found in over.items())
        raise QuarantineError(f"bad lines over the limit of {most:.2%}: {told}")
    return {table: found.good for table, found in checked.items()}
