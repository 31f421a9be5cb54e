"""Scalar functions on boundary values, nulls and NaN."""

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from scholaris.functions import calendar, grades, identity, numeric

NAN = float("nan")


def apply(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", build("x").alias("y")).orderBy("i").collect()]


def test_years_and_semesters(spark):
    days = [date(2025, 9, 15), date(2025, 7, 31), date(2025, 8, 1), date(2025, 6, 30), date(2025, 7, 1), None]
    assert apply(spark, days, "date", calendar.academic_year) == [2026, 2025, 2026, 2025, 2025, None]
    assert apply(spark, days, "date", calendar.fiscal_year) == [2026, 2026, 2026, 2025, 2026, None]
    assert apply(spark, days, "date", calendar.semester) == ["Fall", "Summer", "Fall", "Summer", "Summer", None]
    ends = [date(2025, 1, 1), date(2025, 5, 31), date(2025, 12, 31)]
    assert apply(spark, ends, "date", calendar.semester) == ["Spring", "Spring", "Fall"]
    assert apply(spark, ends, "date", calendar.date_key) == [20250101, 20250531, 20251231]


@pytest.mark.parametrize(
    "freq, want",
    [
        ("W", [date(2024, 2, 25), date(2024, 3, 3)]),
        ("M", [date(2024, 2, 29)]),
        ("Y", []),
    ],
)
def test_date_spine(spark, freq, want):
    bounds = spark.createDataFrame([(date(2024, 2, 25), date(2024, 3, 3))], "a date, b date")
    got = sorted(r.calendar_date for r in calendar.date_spine(bounds, "a", "b", freq).collect())
    assert got == want
    assert calendar.date_spine(bounds, "a", "b", "D").count() == 8
    assert calendar.date_spine(bounds, "b", "a", "D").count() == 0


def test_consecutive_terms_differ_by_one(spark):
    rows = [(2024, "Spring"), (2024, "Fall"), (2025, "Spring"), (2024, "Summer")]
    df = spark.createDataFrame(rows, "y long, s string").coalesce(1)
    got = [r.t for r in df.select(calendar.term_index("y", "s").alias("t")).collect()]
    assert got == [4048, 4049, 4050, None]


def test_grant_status(spark):
    days = [date(2026, 7, 17), date(2026, 7, 16), None]
    assert apply(spark, days, "date", lambda c: calendar.grant_status(c, date(2026, 7, 16))) == [
        "Active",
        "Completed",
        None,
    ]


def test_letter_grades(spark):
    points = [4.0, 3.7, 3.3, 3.0, 2.7, 2.3, 2.0, 1.3, 1.0, 0.99, 0.0, None, NAN]
    catalog = ["A", "A", "A-", "B+", "B", "B-", "C+", "C", "D", "F", "F", None, None]
    transcript = ["A", "A", "A-", "B+", "B", "B-", "C", "D", "D", "F", "F", None, None]
    assert apply(spark, points, "double", grades.letter_grade) == catalog
    assert apply(spark, points, "double", lambda c: grades.letter_grade(c, grades.TRANSCRIPT_SCALE)) == transcript


def test_letter_points(spark):
    letters = ["A", "A-", "C-", "D-", "F", "I", "W", "Z", None]
    assert apply(spark, letters, "string", grades.letter_points) == [4.0, 3.7, 1.7, 0.7, 0.0, None, None, None, None]


def gpa(spark, rows):
    df = spark.createDataFrame(rows, "p double, c long")
    return df.agg(grades.weighted_gpa("p", "c").alias("g")).collect()[0].g


def test_weighted_gpa(spark):
    assert gpa(spark, [(3.5, 3), (3.0, 4), (3.5, 3)]) == pytest.approx(3.3)
    assert gpa(spark, []) == 0.0
    assert gpa(spark, [(4.0, 0)]) == 0.0
    assert gpa(spark, [(4.0, 3), (None, 5)]) == 4.0


def test_degree_progress(spark):
    assert apply(spark, [0, 60, 120, 130, None], "long", grades.degree_progress) == [0.0, 0.5, 1.0, 1.0, None]
    none_required = lambda c: grades.degree_progress(c, F.lit(0))
    assert apply(spark, [30], "long", none_required) == [0.0]


def test_gpa_bands(spark):
    got = apply(spark, [3.5, 3.49, 3.0, 2.5, 2.49, None, NAN], "double", grades.gpa_band)
    assert got == ["3.5 and above", "3.0 to 3.5", "3.0 to 3.5", "2.5 to 3.0", "below 2.5", None, None]


def test_pseudonym(spark):
    want = hashlib.sha256(b"STU_1pepper").hexdigest()
    assert apply(spark, ["STU_1", None], "string", lambda c: identity.pseudonym(c, "pepper")) == [want[:16], None]
    assert apply(spark, ["STU_1"], "string", lambda c: identity.pseudonym(c, "pepper", 64)) == [want]


def test_padded_id_keeps_wide_numbers(spark):
    got = apply(spark, [7, 123, 12345, None], "long", lambda c: identity.padded_id("X_", c, 3))
    assert got == ["X_007", "X_123", "X_12345", None]


def test_valid_email(spark):
    mails = ["a.b+c@x-y.org", "a@b.c", "a@b", "@b.com", "a b@c.com", "a@b.com,", "", None]
    assert apply(spark, mails, "string", identity.valid_email) == [True] + [False] * 7


def test_without_pii(spark):
    df = spark.createDataFrame([(1, "n", "s", "m")], "id int, First_Name string, SSN string, major string")
    assert identity.without_pii(df).columns == ["id", "major"]


def test_predicates_are_false_for_unknown(spark):
    values = [0.0, 4.0, 4.01, -0.1, None, NAN]
    assert apply(spark, values, "double", lambda c: numeric.within(c, 0.0, 4.0)) == [True, True] + [False] * 4
    assert apply(spark, [1.0, 0.0, -1.0, None, NAN], "double", numeric.positive) == [True] + [False] * 4


def test_clip_and_z_score(spark):
    assert apply(spark, [-1.0, 2.0, 9.0, None, NAN], "double", lambda c: numeric.clip(c, 0.0, 4.0)) == [
        0.0,
        2.0,
        4.0,
        None,
        None,
    ]
    score = lambda c: numeric.z_score(c, F.lit(2.0), F.lit(0.5))
    assert apply(spark, [2.0, 3.0, None], "double", score) == [0.0, 2.0, None]
    assert apply(spark, [9.0], "double", lambda c: numeric.z_score(c, F.lit(2.0), F.lit(0.0))) == [0.0]
    edge = lambda c: numeric.is_outlier(c, F.lit(0.0), F.lit(1.0))
    assert apply(spark, [3.0, 3.01, -3.01, None, NAN], "double", edge) == [False, True, True, False, False]


def test_ratio_by_zero_is_null(spark):
    assert apply(spark, [4, 0, None], "long", lambda c: numeric.ratio(F.lit(8), c)) == [2.0, None, None]


def test_tenure(spark):
    rows = [
        (0, "Full Professor", "x", "Tenured"),
        (1, "Associate Professor", "Tenure-Track", "Tenure-Track"),
        (2, "Assistant Professor", "x", "Tenure-Track"),
        (3, "Adjunct", "x", "Non-Tenure-Track"),
        (4, None, "x", None),
    ]
    df = spark.createDataFrame(rows, "i int, r string, t string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", grades.tenure_status("r", "t")).collect())
