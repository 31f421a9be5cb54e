"""Staging to star schema: cleaned view, dimensions and facts.

Frames whose rows are numbered come from `ranking.positioned`.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.functions import calendar, grades
from scholaris.functions.numeric import ratio
from scholaris.operators.ranking import dense_key, position_columns
from scholaris.operators.registry import extend, keyed


def students_cleaned(students: DataFrame) -> DataFrame:
    return students.select(
        "student_id",
        "cohort_year",
        F.upper("major").alias("major"),
        F.round("gpa", 2).alias("gpa"),
        "enrollment_status",
        "date_enrolled",
    )


def _dimension(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return dense_key(df.select(*columns, *position_columns(df)), key, columns)


# (key, id and attributes) of the dimensions of things with an id.
STUDENT = ("student_key", ["student_id", "major", "gpa"])
FACULTY = ("faculty_key", ["faculty_id", "rank", "department"])
COURSE = ("course_key", ["course_id", "course_code", "course_title", "credits", "instructor_id"])


def dim_student(students: DataFrame) -> DataFrame:
    return _dimension(students, *STUDENT).withColumn("dw_is_current", F.lit(True))


def dim_faculty(faculty: DataFrame) -> DataFrame:
    return _dimension(faculty, *FACULTY).withColumn("dw_is_current", F.lit(True))


def dim_course(courses: DataFrame) -> DataFrame:
    return _dimension(courses, *COURSE)


def lasting(rows: DataFrame, dimension: tuple[str, list[str]], registry: str, load: str) -> DataFrame:
    """A dimension whose keys stay from load to load, handed out by the registry at a path."""
    key, columns = dimension
    members = rows.select(*columns)
    return keyed(members, extend(members, registry, load, columns[0], key), columns[0], key)


def lasting_students(students: DataFrame, registry: str, load: str) -> DataFrame:
    return lasting(students, STUDENT, registry, load).withColumn("dw_is_current", F.lit(True))


def lasting_faculty(faculty: DataFrame, registry: str, load: str) -> DataFrame:
    return lasting(faculty, FACULTY, registry, load).withColumn("dw_is_current", F.lit(True))


def lasting_courses(courses: DataFrame, registry: str, load: str) -> DataFrame:
    return lasting(courses, COURSE, registry, load)


def dim_department(faculty: DataFrame) -> DataFrame:
    return _dimension(faculty.select("department").distinct(), "department_key", ["department"])


def dim_funding_agency(grants: DataFrame) -> DataFrame:
    return _dimension(grants.select("funding_agency").distinct(), "agency_key", ["funding_agency"])


def dim_date(students: DataFrame, august_rule: bool = False) -> DataFrame:
    """One row per enrolment date and academic year.

    The academic year is the cohort's, so two cohorts that share a date give two rows;
    with `august_rule` it follows from the date and dates are unique.
    """
    year = calendar.academic_year("date_enrolled") if august_rule else F.col("cohort_year")
    return students.select(
        calendar.date_key("date_enrolled").alias("date_key"),
        F.col("date_enrolled").alias("calendar_date"),
        year.alias("academic_year"),
    ).distinct()


def fact_enrollment(enrollments: DataFrame, dim_student: DataFrame) -> DataFrame:
    """Enrollments of known students. Rows whose student is unknown or null drop out."""
    used = ["enrollment_id", "student_id", "course_id", "grade", "grade_point", "year"]
    students = dim_student.select("student_id", "student_key")
    rows = enrollments.select(*used, *position_columns(enrollments)).join(students, "student_id")
    rows = rows.drop("student_id").withColumnRenamed("year", "academic_year")
    order = ["enrollment_id", "student_key", "course_id", "grade", "grade_point", "academic_year"]
    return dense_key(rows, "enrollment_key", order).select(
        "enrollment_key", "student_key", "course_id", "grade", "grade_point", "academic_year"
    )


def fact_research_grant(grants: DataFrame, dim_faculty: DataFrame) -> DataFrame:
    """Grants of known investigators."""
    used = ["grant_id", "pi_id", "award_amount", "status", "publication_count"]
    faculty = dim_faculty.select(F.col("faculty_id").alias("pi_id"), F.col("faculty_key").alias("pi_key"))
    rows = grants.select(*used, *position_columns(grants)).join(faculty, "pi_id").drop("pi_id")
    rows = rows.withColumnRenamed("status", "current_status")
    order = ["grant_id", "pi_key", "award_amount", "current_status", "publication_count"]
    return dense_key(rows, "grant_key", order).select("grant_key", *order)


def fact_student_performance(enrollments: DataFrame, students: DataFrame) -> DataFrame:
    """Courses, credits and GPA per known student and year."""
    yearly = (
        enrollments.filter(F.col("student_id").isNotNull())
        .groupBy("student_id", F.col("year").alias("academic_year"))
        .agg(
            F.count("course_id").alias("courses"),
            F.sum("credits_earned").alias("credits_earned"),
            F.round(grades.weighted_gpa("grade_point", "credits_earned"), 6).alias("gpa"),
        )
    )
    return yearly.join(students.select("student_id"), "student_id", "left_semi")


def fact_faculty_productivity(faculty: DataFrame, grants: DataFrame, courses: DataFrame) -> DataFrame:
    """Grants, awards, publications, courses and mean rating per faculty member."""
    research = grants.groupBy(F.col("pi_id").alias("faculty_id")).agg(
        F.count("*").alias("grants"),
        F.sum("award_amount").alias("award_amount"),
        F.sum("publication_count").alias("publications"),
    )
    teaching = courses.groupBy(F.col("instructor_id").alias("faculty_id")).agg(
        F.count("*").alias("courses"), F.round(F.avg("avg_rating"), 6).alias("mean_rating")
    )
    counts = ["grants", "award_amount", "publications", "courses"]
    joined = (
        faculty.select("faculty_id", "rank", "department")
        .join(research, "faculty_id", "left")
        .join(teaching, "faculty_id", "left")
    )
    return joined.select(
        "faculty_id",
        "rank",
        "department",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        "mean_rating",
    )


def fact_course_performance(courses: DataFrame, enrollments: DataFrame) -> DataFrame:
    """Graded rows, share of F and mean grade point per course, next to its listed pass rate."""
    results = enrollments.groupBy("course_id").agg(
        F.count("grade").alias("graded"),
        F.count_if(F.col("grade") == "F").alias("failed"),
        F.round(F.avg("grade_point"), 6).alias("mean_grade_point"),
    )
    zero = F.lit(0).cast("long")
    return courses.select("course_id", "pass_rate").join(results, "course_id", "left").select(
        "course_id",
        F.coalesce("graded", zero).alias("graded"),
        F.round(ratio("failed", "graded"), 6).alias("fail_share"),
        "mean_grade_point",
        F.col("pass_rate").alias("listed_pass_rate"),
    )
