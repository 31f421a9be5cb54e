"""Scalar functions, applied to whole tables."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.functions import calendar, grades, identity, numeric
from scholaris.plans.catalog import EXAMPLE_SALT, Tables, query
from scholaris.settings import PII_FIELDS

C = F.col


@query(
    "academic_calendar",
    """select o_orderkey,
              cast(year(o_orderdate) + case when month(o_orderdate) >= 8 then 1 else 0 end as bigint) as academic_year,
              cast(year(o_orderdate) + case when month(o_orderdate) >= 7 then 1 else 0 end as bigint) as fiscal_year,
              case when month(o_orderdate) >= 8 then 'Fall' when month(o_orderdate) <= 5 then 'Spring'
                   else 'Summer' end as semester
       from orders""",
)
def academic_calendar(t: Tables):
    return t.source("orders").select(
        "o_orderkey",
        calendar.academic_year("o_orderdate").alias("academic_year"),
        calendar.fiscal_year("o_orderdate").alias("fiscal_year"),
        calendar.semester("o_orderdate").alias("semester"),
    )


@query(
    "date_spine",
    """select f.freq, d.calendar_date
       from (select cast(unnest(generate_series(min(start_date), max(start_date), interval 1 day)) as date)
                    as calendar_date from grants) d,
            (select unnest(['D', 'W', 'M', 'Y']) as freq) f
       where f.freq = 'D' or (f.freq = 'W' and dayofweek(d.calendar_date) = 0)
          or (f.freq = 'M' and last_day(d.calendar_date) = d.calendar_date)
          or (f.freq = 'Y' and month(d.calendar_date) = 12 and day(d.calendar_date) = 31)""",
)
def date_spine(t: Tables):
    bounds = t.grants.agg(F.min("start_date").alias("first"), F.max("start_date").alias("last"))
    parts = [
        calendar.date_spine(bounds, "first", "last", freq).select(F.lit(freq).alias("freq"), "calendar_date")
        for freq in ("D", "W", "M", "Y")
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "pseudonymized_ids",
    f"select sha256(student_id || '{EXAMPLE_SALT}')[1:16] as student_pseudonym, major from students",
)
def pseudonymized_ids(t: Tables):
    return t.students.select(identity.pseudonym("student_id", EXAMPLE_SALT).alias("student_pseudonym"), "major")


@query(
    "grade_letters",
    """select enrollment_id, grade_point,
              case when grade_point >= 3.7 then 'A' when grade_point >= 3.3 then 'A-' when grade_point >= 3.0 then 'B+'
                   when grade_point >= 2.7 then 'B' when grade_point >= 2.3 then 'B-' when grade_point >= 2.0 then 'C+'
                   when grade_point >= 1.3 then 'C' when grade_point >= 1.0 then 'D' else 'F' end as catalog_letter,
              grade as transcript_letter
       from enrollments""",
)
def grade_letters(t: Tables):
    return t.enrollments.select(
        "enrollment_id",
        "grade_point",
        grades.letter_grade("grade_point").alias("catalog_letter"),
        grades.letter_grade("grade_point", grades.TRANSCRIPT_SCALE).alias("transcript_letter"),
    )


@query(
    "letter_points",
    """select enrollment_id, grade,
              case grade when 'A' then 4.0e0 when 'A-' then 3.7e0 when 'B+' then 3.3e0 when 'B' then 3.0e0
                         when 'B-' then 2.7e0 when 'C+' then 2.3e0 when 'C' then 2.0e0 when 'C-' then 1.7e0
                         when 'D+' then 1.3e0 when 'D' then 1.0e0 when 'D-' then 0.7e0 when 'F' then 0.0e0 end as points
       from enrollments""",
)
def letter_points(t: Tables):
    return t.enrollments.select("enrollment_id", "grade", grades.letter_points("grade").alias("points"))


@query(
    "degree_progress",
    "select student_id, credits_completed, round(least(credits_completed / 120e0, 1), 6) as progress from students",
)
def degree_progress(t: Tables):
    progress = F.round(grades.degree_progress("credits_completed"), 6)
    return t.students.select("student_id", "credits_completed", progress.alias("progress"))


@query(
    "gpa_clipped",
    """select student_id, gpa, case when gpa is not null then least(greatest(gpa, 0.0e0), 4.0e0) end as clipped
       from students""",
)
def gpa_clipped(t: Tables):
    return t.students.select("student_id", "gpa", numeric.clip("gpa", 0.0, 4.0).alias("clipped"))


@query(
    "gpa_bands",
    """select student_id, gpa, case when gpa >= 3.5 then '3.5 and above' when gpa >= 3.0 then '3.0 to 3.5'
                                    when gpa >= 2.5 then '2.5 to 3.0' when gpa is not null then 'below 2.5' end as band
       from students""",
)
def gpa_bands(t: Tables):
    return t.students.select("student_id", "gpa", grades.gpa_band("gpa").alias("band"))


@query(
    "formatted_ids",
    """select 'CUS_' || case when length(c_custkey::varchar) > 3 then c_custkey::varchar
                             else lpad(c_custkey::varchar, 3, '0') end as short_id,
              'CUS_' || lpad(c_custkey::varchar, 12, '0') as long_id
       from customer""",
)
def formatted_ids(t: Tables):
    return t.source("customer").select(
        identity.padded_id("CUS_", "c_custkey", 3).alias("short_id"),
        identity.padded_id("CUS_", "c_custkey", 12).alias("long_id"),
    )


@query(
    "credits_earned_expected",
    """select e.enrollment_id, e.grade, e.credits_earned,
              cast(case when e.grade = 'F' then 0 else c.credits end as bigint) as expected_credits,
              e.credits_earned = case when e.grade = 'F' then 0 else c.credits end as as_expected
       from enrollments e join courses c using (course_id)""",
)
def credits_earned_expected(t: Tables):
    joined = t.enrollments.select("enrollment_id", "course_id", "grade", "credits_earned").join(
        t.courses.select("course_id", "credits"), "course_id"
    )
    expected = grades.credits_for_grade("grade", "credits")
    return joined.select(
        "enrollment_id",
        "grade",
        "credits_earned",
        expected.alias("expected_credits"),
        (C("credits_earned") == expected).alias("as_expected"),
    )


@query(
    "grant_status_derived",
    """select grant_id, end_date, status as recorded_status,
              case when end_date > date '2000-07-16' then 'Active' else 'Completed' end as derived_status
       from grants""",
)
def grant_status_derived(t: Tables):
    derived = calendar.grant_status("end_date", date(2000, 7, 16))
    return t.grants.select(
        "grant_id", "end_date", C("status").alias("recorded_status"), derived.alias("derived_status")
    )


@query(
    "tenure_expected",
    """select faculty_id, rank, tenure_status as recorded,
              case rank when 'Full Professor' then 'Tenured' when 'Associate Professor' then tenure_status
                        when 'Assistant Professor' then 'Tenure-Track' else 'Non-Tenure-Track' end as expected
       from faculty""",
)
def tenure_expected(t: Tables):
    expected = grades.tenure_status("rank", "tenure_status")
    return t.faculty.select("faculty_id", "rank", C("tenure_status").alias("recorded"), expected.alias("expected"))


@query(
    "predicate_flags",
    """select student_id as id, 'gpa' as predicate, coalesce(gpa between 0.0 and 4.0, false) as valid from students
       union all
       select student_id, 'date_logic', coalesce(date_enrolled <= date_graduated, false) from students
       union all
       select faculty_id, 'salary', coalesce(salary > 0, false) from faculty""",
)
def predicate_flags(t: Tables):
    def flags(df, key, name, valid):
        return df.select(C(key).alias("id"), F.lit(name).alias("predicate"), valid.alias("valid"))

    return (
        flags(t.students, "student_id", "gpa", numeric.within("gpa", 0.0, 4.0))
        .unionByName(flags(t.students, "student_id", "date_logic", numeric.in_order("date_enrolled", "date_graduated")))
        .unionByName(flags(t.faculty, "faculty_id", "salary", numeric.positive("salary")))
    )


@query(
    "email_valid",
    r"""select c_custkey, email, regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$') as valid
        from (select c_custkey, lower(replace(c_name, '#', '_'))
                     || case when c_custkey % 7 = 0 then '' else '@' end || 'example.edu' as email
              from customer) c""",
)
def email_valid(t: Tables):
    sign = F.when(C("c_custkey") % 7 == 0, "").otherwise("@")
    email = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("_"))), sign, F.lit("example.edu"))
    addresses = t.source("customer").select("c_custkey", email.alias("email"))
    return addresses.withColumn("valid", identity.valid_email("email"))


@query("pii_columns_dropped", "select c_custkey, c_nationkey, c_acctbal, c_mktsegment from customer")
def pii_columns_dropped(t: Tables):
    return identity.without_pii(t.source("customer"), [*PII_FIELDS, "c_name"])
