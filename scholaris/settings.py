"""Names, limits and lists that results depend on. All of them are fixed values."""

from datetime import date

# The day that rules about "now" are measured against unless a caller says otherwise.
AS_OF = date(2026, 7, 16)

# Unique key of each staging table.
KEYS = {
    "students": ["student_id"],
    "faculty": ["faculty_id"],
    "grants": ["grant_id"],
    "courses": ["course_id"],
    "enrollments": ["enrollment_id"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("enrollments", "student_id", "students", "student_id"),
    ("enrollments", "course_id", "courses", "course_id"),
    ("grants", "pi_id", "faculty", "faculty_id"),
    ("courses", "instructor_id", "faculty", "faculty_id"),
]

# Lowest acceptable rate of each check, and the largest acceptable null share of a column.
THRESHOLDS = {
    "completeness": 0.95,
    "uniqueness": 0.98,
    "validity": 0.99,
    "consistency": 0.97,
}
NULL_SHARE_LIMIT = 0.10

# Columns screened for outliers and the z-score limit.
ANOMALY_COLUMNS = ["gpa", "salary", "award_amount", "grade_point", "pass_rate"]
Z_LIMIT = 3.0

# Alert limits.
QUALITY_ALERT_BELOW = 0.995
FRESHNESS_ALERT_HOURS = 6

# Days a record is kept, by kind.
RETENTION_DAYS = {
    "staging": 7,
    "pipeline_logs": 60,
    "student_records": 2555,
    "faculty_records": 2555,
    "grant_records": 3650,
}
# The date that a record's age counts from: graduation, hiring, the end of the grant.
RECORD_DATES = {
    "students": ("student_records", "date_graduated"),
    "faculty": ("faculty_records", "hire_date"),
    "grants": ("grant_records", "end_date"),
}

# Columns that never leave the staging layer.
PII_FIELDS = ["first_name", "last_name", "ssn", "email", "phone"]

# Demographic groups that may be reported; anything else is reported as Unknown.
APPROVED_ETHNICITIES = [
    "Asian",
    "Black",
    "Hispanic",
    "Native American",
    "Non-Resident Alien",
    "Two or More Races",
    "White",
    "Unknown",
]

# Agencies that get a column of their own in the agency matrix.
FUNDING_AGENCIES = [
    "NSF",
    "NIH",
    "DOE",
    "USDA",
    "DOD",
    "EPA",
    "DOC",
    "Private Foundation",
    "Industrial Partner",
]

AT_RISK_BELOW = 2.5
SALARY_BAND = 25_000
