"""Data quality checks."""

from datetime import datetime

from pyspark.sql import functions as F

from scholaris import settings
from scholaris.operators import integrity, quality, reports
from scholaris.plans.catalog import Tables, query
from scholaris.schemas import STAGING
from scholaris.sources.workspace import stored

C = F.col
STAGING_NAMES = list(STAGING)

# What each rule demands of a row. The oracle counts rows that do not meet it; a null meets
# every rule but the one on course credits.
_VALID = {
    ("students", "validity"): {
        "invalid_gpa": "gpa between 0 and 4",
        "invalid_cohort_year": "cohort_year between 2000 and year(date '2026-07-16') + 1",
        "invalid_date_logic": "date_diff('day', date_enrolled, date_graduated) >= 0",
    },
    ("faculty", "validity"): {
        "invalid_salary": "sign(salary) = 1",
        "hire_date_in_future": "date_diff('day', hire_date, date '2026-07-16') >= 0",
    },
    ("grants", "validity"): {
        "invalid_award_amount": "sign(award_amount) = 1",
        "invalid_date_range": "date_diff('day', start_date, end_date) >= 0",
    },
    ("courses", "validity"): {
        "invalid_credits": "coalesce(credits between 1 and 4, false)",
        "invalid_pass_rate": "pass_rate between 0 and 1",
        "invalid_rating": "avg_rating between 1 and 5",
    },
    ("enrollments", "validity"): {
        "invalid_grade_point": "grade_point between 0 and 4",
        "invalid_credits_earned": "sign(credits_earned) >= 0",
    },
    ("students", "consistency"): {
        "active_no_credits": "enrollment_status <> 'Active' or credits_completed <> 0",
        "graduated_insufficient_credits": "enrollment_status <> 'Graduated' or credits_completed >= 120",
    },
    ("enrollments", "consistency"): {"f_grade_with_credits": "grade <> 'F' or credits_earned <= 0"},
}


def _row(table, check, rule, failed, affected):
    threshold = f"{settings.THRESHOLDS[check]}e0" if rule == quality.ALL else "null::double"
    return f"""select '{table}' as table_name, '{check}' as check_name, '{rule}' as rule, cast({failed} as bigint) as failed,
                      cast({affected} as bigint) as affected, count(*) as total, {threshold} as threshold from {table}"""


def _rule_rows(table, check):
    rules = {name: f"not ({valid})" for name, valid in _VALID.get((table, check), {}).items()}
    each = {name: f"count(*) filter (where {broken})" for name, broken in rules.items()}
    anyof = " or ".join(f"({broken})" for broken in rules.values()) or "false"
    total = " + ".join(each.values()) or "0"
    rows = [_row(table, check, name, count, count) for name, count in each.items()]
    return [*rows, _row(table, check, quality.ALL, total, f"count(*) filter (where {anyof})")]


def _completeness_row(table):
    missing = " or ".join(f"{f.name} is null" for f in STAGING[table].fields)
    count = f"count(*) filter (where {missing})"
    return _row(table, "completeness", quality.ALL, count, count)


def _uniqueness_row(table):
    (key,) = settings.KEYS[table]
    # count(distinct) skips null keys, which are one group.
    extra = f"count(*) - count(distinct {key}) - max(case when {key} is null then 1 else 0 end)"
    return _row(table, "uniqueness", quality.ALL, extra, extra)


def _report(rows):
    return f"""select table_name, check_name, rule, failed, affected, total,
                      round(1 - failed / total, 4) as rate, threshold,
                      case when threshold is not null then
                           case when 1 - failed / total >= threshold then 'PASS' else 'FAIL' end end as status
               from ({" union all ".join(rows)}) r"""


_COMPLETENESS = _report([_completeness_row(n) for n in STAGING_NAMES])
_UNIQUENESS = _report([_uniqueness_row(n) for n in STAGING_NAMES])
_CONSISTENCY = _report([r for n in STAGING_NAMES for r in _rule_rows(n, "consistency")])
CHECKS = _report(
    [
        row
        for n in STAGING_NAMES
        for row in [_completeness_row(n), _uniqueness_row(n), *_rule_rows(n, "validity"), *_rule_rows(n, "consistency")]
    ]
)


@query("completeness_by_table", _COMPLETENESS)
def completeness_by_table(t: Tables):
    return quality.union([quality.row_checks(df, n, checks=("completeness",)) for n, df in t.all().items()])


@query(
    "completeness_by_column",
    "select *, null_share > 0.10 as over_limit from ("
    + " union all ".join(
        f"""select '{n}' as table_name, '{f.name}' as column_name, count(*) filter (where {f.name} is null) as null_count,
                   count(*) filter (where {f.name} is null) / count(*)::double as null_share from {n}"""
        for n in STAGING_NAMES
        for f in STAGING[n].fields
    )
    + ") c",
)
def completeness_by_column(t: Tables):
    return quality.union([quality.completeness_by_column(df, n) for n, df in t.all().items()])


@query("uniqueness_by_table", _UNIQUENESS)
def uniqueness_by_table(t: Tables):
    return quality.union([quality.uniqueness(df, n) for n, df in t.all().items()])


def _register_validity(name: str) -> None:
    @query(f"validity_{name}", _report(_rule_rows(name, "validity")))
    def validity(t: Tables):
        return quality.row_checks(getattr(t, name), name, checks=("validity",))


for _name in STAGING_NAMES:
    _register_validity(_name)


@query("consistency_by_table", _CONSISTENCY)
def consistency_by_table(t: Tables):
    return quality.union([quality.row_checks(df, n, checks=("consistency",)) for n, df in t.all().items()])


@query("quality_checks", CHECKS)
def quality_checks(t: Tables):
    return t.landed().checks


_SCREENED = {
    "students": "gpa",
    "faculty": "salary",
    "grants": "award_amount",
    "courses": "pass_rate",
    "enrollments": "grade_point",
}
_ANOMALIES = " union all ".join(
    f"""select '{n}' as table_name, '{c}' as column_name, any_value(n) as checked_values,
               coalesce(any_value(deviation > 0), false) as screened,
               count(*) filter (where deviation > 0 and abs(({c} - mean) / deviation) > 3) as anomalous
        from {n}, (select count({c}) as n, avg({c}) as mean, stddev_samp({c}) as deviation from {n}) s"""
    for n, c in _SCREENED.items()
)


@query("anomalies_by_column", _ANOMALIES)
def anomalies_by_column(t: Tables):
    # Two passes over the outcome of a join: its one screened column is written down for them.
    return quality.anomalies_of(t.all() | {"enrollments": stored(quality.screened(t.enrollments), "screened")})


_SCORECARD = f"""
select table_name, row_count, completeness, uniqueness, validity, consistency,
       round(completeness * 0.25 + uniqueness * 0.25 + validity * 0.25 + consistency * 0.25, 4) as overall_quality_score,
       anomalies_detected
from (select table_name, max(total) as row_count,
             max(rate) filter (where check_name = 'completeness') as completeness,
             max(rate) filter (where check_name = 'uniqueness') as uniqueness,
             max(rate) filter (where check_name = 'validity') as validity,
             max(rate) filter (where check_name = 'consistency') as consistency
      from ({CHECKS}) c where rule = 'all' group by table_name) t
join (select table_name, sum(anomalous) > 0 as anomalies_detected from ({_ANOMALIES}) a group by table_name) b
  using (table_name)"""


def _scorecard(t: Tables):
    return quality.scored(t.landed().all())


@query("quality_scorecard", _SCORECARD)
def quality_scorecard(t: Tables):
    return _scorecard(t)


@query(
    "quality_alerts",
    f"select table_name, overall_quality_score from ({_SCORECARD}) s where overall_quality_score < 0.995",
)
def quality_alerts(t: Tables):
    return quality.alerts(_scorecard(t))


GATE = f"""
select table_name, checks, passed, case when passed = checks then 'PASS' else 'FAIL' end as status
from (select coalesce(table_name, 'all') as table_name, count(*) as checks,
             count(*) filter (where status = 'PASS') as passed
      from ({CHECKS}) c where rule = 'all' group by rollup(table_name)) g"""


@query("quality_gate", GATE)
def quality_gate(t: Tables):
    return quality.gate(t.landed().checks)


@query(
    "null_key_counts",
    """select 'dim_student' as table_name, 'student_id' as column_name, count(*) as null_count
       from dim_student where student_id is null
       union all
       select 'fact_enrollment', 'student_key', count(*) from fact_enrollment where student_key is null
       union all
       select 'enrollments', 'student_id', count(*) from enrollments where student_id is null""",
)
def null_key_counts(t: Tables):
    return integrity.null_counts(
        [
            (t.students, "dim_student", "student_id"),
            (t.known_enrollments.withColumnRenamed("student_id", "student_key"), "fact_enrollment", "student_key"),
            (t.enrollments, "enrollments", "student_id"),
        ]
    )


@query(
    "duplicate_keys",
    "select enrollment_id, count(*) as dup_count from enrollments group by enrollment_id having count(*) > 1",
)
def duplicate_keys(t: Tables):
    return integrity.duplicate_keys(t.enrollments, "enrollment_id")


@query(
    "duplicate_student_keys",
    "select student_key, count(*) as dup_count from dim_student group by student_key having count(*) > 1",
)
def duplicate_student_keys(t: Tables):
    return integrity.duplicate_keys(t.dim_student, "student_key")


@query(
    "invalid_gpa_count",
    "select count(*) as invalid_gpa_records from dim_student where gpa < 0.0 or gpa > 4.0",
)
def invalid_gpa_count(t: Tables):
    return reports.invalid_gpa_rows(t.students).agg(F.count("*").alias("invalid_gpa_records"))


_REFERENCES = [
    ("fact_enrollment", "student_key", "dim_student", "student_key"),
    *[fk for fk in settings.FOREIGN_KEYS],
]


def _reference_sql(child, column, parent, key):
    unknown = f"{column} is null or {column} not in (select {key} from {parent} where {key} is not null)"
    return f"""select '{child}' as child, '{column}' as child_column, '{parent}' as parent, count(*) as total_rows,
                      count(*) filter (where {unknown}) as orphan_rows,
                      count(distinct {column}) filter (where {unknown}) as orphan_keys from {child}"""


def _references(pairs):
    return f"""select *, round(orphan_rows / total_rows::double, 6) as orphan_rate,
                      case when orphan_keys = 0 then 'PASS' else 'FAIL' end as status
               from ({" union all ".join(_reference_sql(*p) for p in pairs)}) r"""


@query("referential_integrity", _references(_REFERENCES))
def referential_integrity(t: Tables):
    t = t.landed()
    return quality.union([_star_reference(t), *integrity.staging_references(t.all())])


@query(
    "orphan_rows",
    f"select child, parent, orphan_rows from ({_references(_REFERENCES[:2])}) r",
)
def orphan_rows(t: Tables):
    return _enrollment_orphans(t).select("child", "parent", "orphan_rows")


@query(
    "orphan_keys",
    f"select child, parent, orphan_keys from ({_references(_REFERENCES[:2])}) r",
)
def orphan_keys(t: Tables):
    return _enrollment_orphans(t).select("child", "parent", "orphan_keys")


def _enrollment_orphans(t: Tables):
    staged = integrity.reference_check(t.enrollments, "student_id", t.students, "student_id", "enrollments", "students")
    return quality.union([_star_reference(t), staged])


def _star_reference(t: Tables):
    """The fact's rows before they get surrogate keys; a run checks the fact that it has built."""
    return integrity.star_reference(t.known_enrollments, t.students, "student_id")


@query(
    "fact_has_rows",
    """select 'fact_enrollment_has_rows' as check_name, count(*) as row_count,
              case when count(*) > 0 then 'PASS' else 'FAIL' end as status from fact_enrollment""",
)
def fact_has_rows(t: Tables):
    return integrity.has_rows(t.known_enrollments, "fact_enrollment")


POST_LOAD = f"""
select 'fact_enrollment_has_rows' as check_name, cast(count(*) = 0 as bigint) as failed,
       case when count(*) > 0 then 'PASS' else 'FAIL' end as status from fact_enrollment
union all
select child || '_' || child_column || '_fk', orphan_keys, status from ({_references(_REFERENCES)}) r"""


@query("post_load_validation", POST_LOAD)
def post_load_validation(t: Tables):
    t = t.landed()
    return integrity.post_load(t.known_enrollments, t.students, t.all(), "student_id")


@query(
    "freshness_check",
    """select max(ts) as latest,
              round(date_diff('microsecond', max(ts), timestamp '2024-01-31 00:00:00') / 3.6e9, 6) as hours_since,
              case when date_diff('microsecond', max(ts), timestamp '2024-01-31 00:00:00') / 3.6e9 > 6
                   then 'FAIL' else 'PASS' end as status
       from events""",
)
def freshness_check(t: Tables):
    as_of = F.lit(datetime(2024, 1, 31)).cast("timestamp_ntz")
    return quality.freshness(t.source("events"), "ts", as_of)
