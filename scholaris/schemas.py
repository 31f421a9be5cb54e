"""Declared columns of the five staging tables. Nothing is inferred.

The names and types are fixed values.
"""

from pyspark.sql import types as T

_COLUMNS = {
    "students": """
        student_id string, cohort_year bigint, major string, gpa double, enrollment_status string,
        date_enrolled date, date_graduated date, credits_completed bigint, ethnicity string, first_generation boolean
    """,
    "faculty": """
        faculty_id string, rank string, hire_date date, department string, salary bigint,
        employment_status string, tenure_status string, research_focus string
    """,
    "grants": """
        grant_id string, pi_id string, award_amount bigint, funding_agency string, start_date date, end_date date,
        department string, status string, publication_count bigint
    """,
    "courses": """
        course_id string, course_code string, course_title string, credits bigint, semester string, year bigint,
        instructor_id string, enrollment bigint, pass_rate double, avg_rating double
    """,
    "enrollments": """
        enrollment_id string, student_id string, course_id string, semester string, year bigint, grade string,
        grade_point double, credits_earned bigint
    """,
}
_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def _struct(columns: str) -> T.StructType:
    """A schema from DDL; parsing DDL through Spark would need a session."""
    named = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in named])


STAGING = {table: _struct(columns) for table, columns in _COLUMNS.items()}
