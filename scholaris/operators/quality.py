"""Data quality: rules as data, compiled into one aggregate per table.

Every check is reported in the same long form, one row per rule and one row named
`all` per check, so reports of different tables are unions of each other:

    table_name, check_name, rule, failed, affected, total, rate, threshold, status

`rate` is 1 - failed / total, rounded to 4 digits, and 1 for an empty table. The status
is decided on the unrounded rate and stands on the `all` rows only. A row that breaks
two rules of a check counts twice in `failed`; `affected` counts it once.
"""

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholaris import settings
from scholaris.functions.numeric import is_outlier, without_nan
from scholaris.sources.workspace import stored, stored_together

C = F.col


@dataclass(frozen=True)
class Rule:
    """`broken` is a SQL condition; {as_of} and {year} stand for the reference day."""

    table: str
    check: str
    name: str
    broken: str


RULES = [
    Rule("students", "validity", "invalid_gpa", "gpa < 0.0 or gpa > 4.0"),
    Rule("students", "validity", "invalid_cohort_year", "cohort_year < 2000 or cohort_year > {year} + 1"),
    Rule("students", "validity", "invalid_date_logic", "date_graduated < date_enrolled"),
    Rule("faculty", "validity", "invalid_salary", "salary <= 0"),
    Rule("faculty", "validity", "hire_date_in_future", "hire_date > date'{as_of}'"),
    Rule("grants", "validity", "invalid_award_amount", "award_amount <= 0"),
    Rule("grants", "validity", "invalid_date_range", "end_date < start_date"),
    Rule("courses", "validity", "invalid_credits", "credits is null or credits not in (1, 2, 3, 4)"),
    Rule("courses", "validity", "invalid_pass_rate", "pass_rate < 0 or pass_rate > 1"),
    Rule("courses", "validity", "invalid_rating", "avg_rating < 1 or avg_rating > 5"),
    Rule("enrollments", "validity", "invalid_grade_point", "grade_point < 0 or grade_point > 4"),
    Rule("enrollments", "validity", "invalid_credits_earned", "credits_earned < 0"),
    Rule("students", "consistency", "active_no_credits", "enrollment_status = 'Active' and credits_completed = 0"),
    Rule(
        "students",
        "consistency",
        "graduated_insufficient_credits",
        "enrollment_status = 'Graduated' and credits_completed < 120",
    ),
    Rule("enrollments", "consistency", "f_grade_with_credits", "grade = 'F' and credits_earned > 0"),
]

ALL = "all"


def _any(conditions: list[str]) -> str:
    """True if one condition holds; unknown ones do not."""
    return " or ".join(f"coalesce({c}, false)" for c in conditions) or "false"


def _long_form(counts: DataFrame, table: str, entries: list[tuple[str, str, str, str]]) -> DataFrame:
    """One row per (check, rule, failed, affected) of the one-row frame `counts`."""
    cells = []
    for check, rule, failed, affected in entries:
        threshold = f"{settings.THRESHOLDS[check]}d" if rule == ALL else "cast(null as double)"
        cells.append(
            f"named_struct('check_name', '{check}', 'rule', '{rule}', 'failed', {failed}, "
            f"'affected', {affected}, 'threshold', {threshold})"
        )
    rate = "coalesce(1 - failed / nullif(total, 0), 1.0d)"
    return counts.selectExpr("total", f"inline(array({', '.join(cells)}))").selectExpr(
        f"'{table}' as table_name",
        "check_name",
        "rule",
        "failed",
        "affected",
        "total",
        f"round({rate}, 4) as rate",
        "threshold",
        f"case when {rate} >= threshold then 'PASS' when threshold is not null then 'FAIL' end as status",
    )


ROW_CHECKS = ("completeness", "validity", "consistency")


def _row_aggregates(
    df: DataFrame, table: str, as_of: date, nullable: tuple[str, ...], checks: tuple[str, ...]
) -> tuple[list[str], list[tuple[str, str, str, str]]]:
    """What the checks count in a table, and the rows of the report that the counts go to."""
    aggregates = ["count(*) as total"]
    entries = []
    if "completeness" in checks:
        missing = _any([f"`{c}` is null" for c in df.columns if c not in nullable])
        aggregates.append(f"count_if({missing}) as incomplete")
        entries.append(("completeness", ALL, "incomplete", "incomplete"))
    for check in [c for c in ("validity", "consistency") if c in checks]:
        rules = {
            r.name: r.broken.format(as_of=as_of, year=as_of.year)
            for r in RULES
            if r.table == table and r.check == check
        }
        aggregates += [f"count_if({broken}) as {name}" for name, broken in rules.items()]
        aggregates.append(f"count_if({_any(list(rules.values()))}) as {check}_rows")
        entries += [(check, name, name, name) for name in rules]
        entries.append((check, ALL, " + ".join(rules) or "0L", f"{check}_rows"))
    return aggregates, entries


def _screened(df: DataFrame) -> list[str]:
    """The columns of a table that are screened for outliers."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return [c for c in settings.ANOMALY_COLUMNS if c in numeric]


def screened(df: DataFrame) -> DataFrame:
    """The columns of a table that `anomalies` looks at."""
    return df.select(*_screened(df))


def _moments(df: DataFrame) -> list[Column]:
    return [
        F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("deviation")).alias(f"{c}_moments")
        for c in _screened(df)
    ]


def statistics(
    df: DataFrame, table: str, as_of: date = settings.AS_OF, nullable: tuple[str, ...] = ()
) -> DataFrame:
    """One row, from one pass: all that the row checks and the outliers need of a table."""
    aggregates, _ = _row_aggregates(df, table, as_of, nullable, ROW_CHECKS)
    return without_nan(df).agg(*map(F.expr, aggregates), *_moments(df))


def row_checks(
    df: DataFrame,
    table: str,
    as_of: date = settings.AS_OF,
    nullable: tuple[str, ...] = (),
    checks: tuple[str, ...] = ROW_CHECKS,
    known: DataFrame | None = None,
) -> DataFrame:
    """Completeness, validity and consistency of a table in a single pass.

    A row is incomplete if any column outside `nullable` is null. `known` are the table's
    `statistics`, if there are some already.
    """
    aggregates, entries = _row_aggregates(df, table, as_of, nullable, checks)
    counts = without_nan(df).agg(*map(F.expr, aggregates)) if known is None else known
    return _long_form(counts, table, entries)


def uniqueness(df: DataFrame, table: str, keys: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each key; whole rows where the table has no key."""
    keys = keys or settings.KEYS.get(table) or df.columns
    groups = without_nan(df.select(*keys)).groupBy(*keys).agg(F.count("*").alias("n"))
    counts = groups.agg(
        F.expr("coalesce(sum(n), 0L) as total"), F.expr("coalesce(sum(n - 1), 0L) as duplicates")
    )
    return _long_form(counts, table, [("uniqueness", ALL, "duplicates", "duplicates")])


def report(
    tables: dict[str, DataFrame], as_of: date = settings.AS_OF, nullable: tuple[str, ...] = ()
) -> DataFrame:
    """All checks of all tables."""
    parts = []
    for name, df in tables.items():
        parts += [row_checks(df, name, as_of, nullable), uniqueness(df, name)]
    return union(parts)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def completeness_by_column(df: DataFrame, table: str) -> DataFrame:
    """Null count and share per column; the share is null for an empty table."""
    nulls = [F.expr(f"count_if(`{c}` is null) as null_{i}") for i, c in enumerate(df.columns)]
    counts = without_nan(df).agg(F.expr("count(*) as total"), *nulls)
    cells = [f"named_struct('column_name', '{c}', 'null_count', null_{i})" for i, c in enumerate(df.columns)]
    share = "null_count / nullif(total, 0)"
    return counts.selectExpr("total", f"inline(array({', '.join(cells)}))").selectExpr(
        f"'{table}' as table_name",
        "column_name",
        "null_count",
        f"{share} as null_share",
        f"coalesce({share} > {settings.NULL_SHARE_LIMIT}d, false) as over_limit",
    )


def moments(df: DataFrame) -> DataFrame:
    """One row: count, mean and deviation of each screened column."""
    return without_nan(screened(df)).agg(*_moments(df))


def anomalies(df: DataFrame, table: str, known: DataFrame | None = None) -> DataFrame:
    """Values more than the z-limit away from the mean, per screened numeric column.

    Columns without spread are listed with `screened` false. One pass counts the outliers
    of all columns against the moments in `known`, the table's `statistics` as they are
    stored; without it, a pass over the screened columns comes first.
    """
    columns = _screened(df)
    values = without_nan(df.select(*columns))
    known = stored(moments(df), "moments") if known is None else known
    counts, cells = [], []
    for name in columns:
        # One row that is written down: looking a value up in it costs next to nothing.
        found = known.select(f"{name}_moments").scalar()
        mean, deviation = found.getField("mean"), found.getField("deviation")
        spread = F.coalesce(deviation > 0, F.lit(False))
        counts.append(F.count_if(spread & is_outlier(name, mean, deviation, settings.Z_LIMIT)).alias(name))
        cells.append(
            F.struct(
                F.lit(name).alias("column_name"),
                found.getField("n").alias("checked_values"),
                spread.alias("screened"),
                C(name).alias("anomalous"),
            )
        )
    return values.agg(*counts).select(F.inline(F.array(*cells))).select(F.lit(table).alias("table_name"), "*")


def anomalies_of(tables: dict[str, DataFrame], known: dict[str, DataFrame] | None = None) -> DataFrame:
    tables = {name: df for name, df in tables.items() if _screened(df)}
    known = known or stored_together({name: moments(df) for name, df in tables.items()}, "moments")
    return union([anomalies(df, name, known[name]) for name, df in tables.items()])


def scored(tables: dict[str, DataFrame], as_of: date = settings.AS_OF) -> DataFrame:
    """The scorecard of all tables: a pass for the rules and moments, one for the keys, one for the outliers."""
    known = stored_together({name: statistics(df, name, as_of) for name, df in tables.items()}, "statistics")
    checks = [row_checks(df, name, as_of, known=known[name]) for name, df in tables.items()]
    unique = [uniqueness(df, name) for name, df in tables.items()]
    return scorecard(union([*checks, *unique]), anomalies_of(tables, known))


def scorecard(checks: DataFrame, outliers: DataFrame) -> DataFrame:
    """One row per table: the four rounded rates, their mean and whether outliers were found."""
    names = list(settings.THRESHOLDS)
    rates = [F.max(F.when(C("check_name") == c, C("rate"))).alias(c) for c in names]
    found = outliers.groupBy("table_name").agg((F.sum("anomalous") > 0).alias("anomalies_detected"))
    score = reduce(lambda a, b: a + b, [C(c) * 0.25 for c in names])
    return (
        checks.filter(C("rule") == ALL)
        .groupBy("table_name")
        .agg(F.max("total").alias("row_count"), *rates)
        .join(found, "table_name", "left")
        .select(
            "table_name",
            "row_count",
            *names,
            F.round(score, 4).alias("overall_quality_score"),
            F.coalesce("anomalies_detected", F.lit(False)).alias("anomalies_detected"),
        )
    )


def alerts(scores: DataFrame, limit: float = settings.QUALITY_ALERT_BELOW) -> DataFrame:
    return scores.filter(C("overall_quality_score") < limit).select("table_name", "overall_quality_score")


def gate(checks: DataFrame) -> DataFrame:
    """Whether each table passes all its checks, and a row for all tables together."""
    passed = C("status") == "PASS"
    tables = checks.filter(C("rule") == ALL)
    counts = [F.count("*").alias("checks"), F.count_if(passed).alias("passed")]
    each = tables.groupBy("table_name").agg(*counts)
    overall = each.agg(F.sum("checks").alias("checks"), F.sum("passed").alias("passed"))
    both = each.unionByName(overall.withColumn("table_name", F.lit(ALL)))
    return both.withColumn("status", F.when(C("passed") == C("checks"), "PASS").otherwise("FAIL"))


def freshness(df: DataFrame, timestamp: str, as_of: Column, limit: float = settings.FRESHNESS_ALERT_HOURS) -> DataFrame:
    """Hours from the latest timestamp to `as_of`; SKIPPED where there is none."""
    latest = df.agg(F.max(timestamp).alias("latest"))
    micros = F.timestamp_diff("MICROSECOND", C("latest"), as_of)
    hours = F.round(micros / 3.6e9, 6)
    return latest.select(
        "latest",
        hours.alias("hours_since"),
        F.when(hours.isNull(), "SKIPPED").when(hours > limit, "FAIL").otherwise("PASS").alias("status"),
    )
