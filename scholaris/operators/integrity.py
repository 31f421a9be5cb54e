"""Keys: references between tables, duplicates, null keys and row counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris import settings
from scholaris.operators.quality import union
from scholaris.operators.ranking import dense_key

C = F.col


def _matches(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(key, n, parents): child rows per key and the parent rows of that key, null if none.

    Both sides are counted per key before they meet, so a key that holds a third of the
    table costs one row.
    """
    children = child.groupBy(C(child_column).alias("key")).agg(F.count("*").alias("n"))
    parents = parent.groupBy(C(parent_column).alias("key")).agg(F.count("*").alias("parents"))
    return children.join(parents, "key", "left")


def reference_check(
    child: DataFrame, child_column: str, parent: DataFrame, parent_column: str, name: str, target: str, label: str = ""
) -> DataFrame:
    """Rows and distinct keys of the child that have no parent.

    A null key is an orphaned row but not a key. `label` replaces the child column's name.
    """
    counts = _matches(child, child_column, parent, parent_column).agg(
        F.expr("coalesce(sum(n), 0L) as total_rows"),
        F.expr("coalesce(sum(case when parents is null then n end), 0L) as orphan_rows"),
        F.expr("count(case when parents is null then key end) as orphan_keys"),
    )
    return counts.selectExpr(
        f"'{name}' as child",
        f"'{label or child_column}' as child_column",
        f"'{target}' as parent",
        "total_rows",
        "orphan_rows",
        "orphan_keys",
        "round(coalesce(orphan_rows / nullif(total_rows, 0), 0.0d), 6) as orphan_rate",
        "case when orphan_keys = 0 then 'PASS' else 'FAIL' end as status",
    )


def join_flow(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows that go into an inner join from the child, come out of it and are dropped by it."""
    return _matches(child, child_column, parent, parent_column).agg(
        F.expr("coalesce(sum(n), 0L) as rows_in"),
        F.expr("coalesce(sum(n * parents), 0L) as rows_out"),
        F.expr("coalesce(sum(case when parents is null then n end), 0L) as rows_dropped"),
    )


def staging_references(tables: dict[str, DataFrame]) -> list[DataFrame]:
    return [
        reference_check(tables[child], column, tables[parent], key, child, parent)
        for child, column, parent, key in settings.FOREIGN_KEYS
        if child in tables and parent in tables
    ]


def star_reference(fact_enrollment: DataFrame, dim_student: DataFrame, key: str = "student_key") -> DataFrame:
    """The fact's students against the dimension; rows without surrogate keys go by another `key`."""
    return reference_check(fact_enrollment, key, dim_student, key, "fact_enrollment", "dim_student", "student_key")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row, null included."""
    return df.groupBy(key).agg(F.count("*").alias("dup_count")).filter(C("dup_count") > 1)


def duplicate_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """All rows of a `positioned` frame, flagged as duplicate unless first of their key in `order`.

    Rows are numbered once over the whole table, so the rows of a key follow each other:
    a row is a duplicate if the row before has its key. No key is gathered or joined.
    """
    return dense_key(df, "position", [key, *order], again="is_duplicate")


def null_counts(columns: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Null count of each (frame, table name, column)."""
    return union(
        [
            df.agg(F.count_if(C(column).isNull()).alias("null_count")).select(
                F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "null_count"
            )
            for df, table, column in columns
        ]
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union(
        [
            df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def has_rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(f"{name}_has_rows").alias("check_name"),
        "row_count",
        F.when(C("row_count") > 0, "PASS").otherwise("FAIL").alias("status"),
    )


def post_load(
    fact_enrollment: DataFrame, dim_student: DataFrame, tables: dict[str, DataFrame], key: str = "student_key"
) -> DataFrame:
    """Row-count and reference checks after loading, with the failed count of each."""
    filled = has_rows(fact_enrollment, "fact_enrollment").select(
        "check_name", (C("row_count") == 0).cast("long").alias("failed"), "status"
    )
    references = union([star_reference(fact_enrollment, dim_student, key), *staging_references(tables)]).select(
        F.concat_ws("_", "child", "child_column", F.lit("fk")).alias("check_name"),
        C("orphan_keys").alias("failed"),
        "status",
    )
    return filled.unionByName(references)


def pass_counts(checks: DataFrame) -> DataFrame:
    return checks.agg(F.count("*").alias("checks"), F.count_if(C("status") == "PASS").alias("passed"))
