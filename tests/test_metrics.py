"""Metrics on literal tables: null groups, hot students, missing years, zero publications."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from scholaris.operators import metrics, reports, views

STUDENT = "student_id string, major string, cohort_year long"
ENROLLED = "student_id string, year long, semester string, grade_point double, credits_earned long"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_cost_per_publication_without_publications_comes_first(spark):
    grants = frame(spark, [("B", 100, 4), ("A", 50, 0), ("C", 10, 10)], "department string, award_amount long, publication_count long")
    got = [tuple(r) for r in reports.cost_per_publication(grants).collect()]
    assert got == [("A", None), ("C", 1.0), ("B", 25.0)]


def test_agencies_off_the_list_are_not_lost(spark):
    rows = [("D", "NSF", 5), ("D", "Moon Fund", 7), ("D", None, 1), ("E", "NIH", 2)]
    grants = frame(spark, rows, "department string, funding_agency string, award_amount long")
    wide = {r.department: r for r in reports.agency_department_pivot(grants).collect()}
    assert (wide["D"].NSF, wide["D"].other, wide["D"].NIH) == (5, 8, None)
    assert wide["E"].NIH == 2
    long = reports.agency_department(grants)
    assert long.agg(F.sum("award_amount")).collect()[0][0] == 15


def test_outliers_of_an_unknown_agency_are_kept(spark):
    rows = [(f"g{i}", None, 10 + i % 2) for i in range(40)] + [("far", None, 900)]
    grants = frame(spark, rows, "grant_id string, funding_agency string, award_amount long")
    assert [r.grant_id for r in reports.award_outliers(grants).collect()] == ["far"]


def test_unapproved_groups_are_unknown(spark):
    students = frame(spark, [("White", True), ("Martian", True), (None, True)], "ethnicity string, first_generation boolean")
    got = {r.ethnicity: r.students for r in reports.demographics(students).collect()}
    assert got == {"White": 1, "Unknown": 2}


def test_term_retention_skips_summer_and_unknown_students(spark):
    students = frame(spark, [("a", "M", 2020), ("b", "M", 2020)], STUDENT)
    rows = [
        ("a", 2020, "Fall", 3.0, 3),
        ("a", 2020, "Fall", 2.0, 3),
        ("a", 2021, "Spring", 3.0, 3),
        ("b", 2020, "Fall", 3.0, 3),
        ("b", 2021, "Summer", 3.0, 3),
        ("b", 2021, "Fall", 3.0, 3),
        ("x", 2020, "Fall", 3.0, 3),
        (None, 2020, "Fall", 3.0, 3),
    ]
    got = {r.term: (r.students, r.retained, r.final_term) for r in metrics.term_retention(frame(spark, rows, ENROLLED), students).collect()}
    assert got == {4041: (2, 1, False), 4042: (1, 0, False), 4043: (1, 0, True)}


def test_forecast_stays_within_bounds(spark):
    rows = [("M", t, 10, n, t == 5) for t, n in ((1, 2), (2, 6), (3, 10), (5, 0))]
    retention = frame(spark, rows, "major string, term long, students long, retained long, final_term boolean")
    got = metrics.retention_forecast(retention).collect()[0]
    assert (got.terms, got.next_term, got.slope, got.forecast) == (3, 4, 0.4, 1.0)


def test_cohort_retention_counts_students_once(spark):
    students = frame(spark, [("a", "M", 2020), ("b", "M", 2020), ("c", "M", 2021)], STUDENT)
    rows = [("a", 2020, "Fall", 3.0, 3)] * 50 + [("b", 2021, "Fall", 3.0, 3), ("c", 2020, "Fall", 3.0, 3)]
    got = {(r.cohort_year, r.years_since_entry): r.retention_rate for r in metrics.cohort_retention(frame(spark, rows, ENROLLED), students).collect()}
    assert got == {(2020, 0): 0.5, (2020, 1): 0.5}


def test_gpa_improvement_ignores_years_without_credits(spark):
    students = frame(spark, [("a", "M", 2020)], STUDENT)
    rows = [
        ("a", 2019, "Fall", 0.0, 0),
        ("a", 2020, "Fall", 2.0, 1),
        ("a", 2020, "Fall", 4.0, 3),
        ("a", 2022, "Fall", 3.0, 3),
        ("a", 2023, "Fall", None, 3),
        ("x", 2020, "Fall", 2.0, 3),
    ]
    got = metrics.gpa_improvement(frame(spark, rows, ENROLLED), students).collect()
    assert [tuple(r) for r in got] == [("a", 2020, 2022, 3.5, 3.0, -0.5)]


def test_students_without_enrollments_have_gpa_zero(spark):
    students = frame(spark, [("a", "M", 2020)], STUDENT)
    got = metrics.weighted_gpa(frame(spark, [], ENROLLED), students).collect()
    assert [tuple(r) for r in got] == [("a", 0.0, 0)]


def test_on_time_is_within_forty_eight_months(spark):
    rows = [("Graduated", date(2020, 8, 1), d) for d in (date(2024, 8, 1), date(2024, 8, 2), None)]
    rows.append(("Active", date(2020, 8, 1), None))
    students = frame(spark, [("M", *r) for r in rows], "major string, enrollment_status string, date_enrolled date, date_graduated date")
    got = metrics.on_time_graduation(students).collect()[0]
    assert (got.graduates, got.on_time) == (3, 1)


@pytest.mark.parametrize("as_of, want", [(date(2022, 7, 16), "Active"), (date(2022, 8, 1), "Inactive")])
def test_status_follows_the_academic_year(spark, as_of, want):
    students = frame(spark, [("a", "Active", None)], "student_id string, enrollment_status string, date_graduated date")
    rows = frame(spark, [("a", 2021, "Fall", 3.0, 3)], ENROLLED)
    assert metrics.enrollment_status(rows, students, as_of).collect()[0].derived_status == want


def test_productivity_without_grants_is_unknown_and_unranked(spark):
    faculty = frame(
        spark,
        [("f1", None, "D"), ("f2", None, "D"), ("f3", None, "D"), ("f4", "Lecturer", "D")],
        "faculty_id string, rank string, department string",
    )
    grants = frame(
        spark, [("f1", 100_000, 1), ("f2", 100_000, 3), ("f3", 0, 2)], "pi_id string, award_amount long, publication_count long"
    )
    courses = frame(spark, [("f1", 4.0), ("f1", 5.0)], "instructor_id string, avg_rating double")
    got = {r.faculty_id: (r.score, r.rank_percentile, r.mean_rating) for r in metrics.faculty_productivity(faculty, grants, courses).collect()}
    assert got == {"f1": (1.0, 0.0, 4.5), "f2": (3.0, 1.0, None), "f3": (None, None, None), "f4": (None, None, None)}


def test_salary_quartiles_keep_the_unknown_department(spark):
    faculty = frame(spark, [("f1", None, 10), ("f2", None, 20)], "faculty_id string, department string, salary long")
    grants = frame(spark, [], "pi_id string, award_amount long, publication_count long")
    got = metrics.salary_vs_productivity(faculty, grants).collect()
    assert [tuple(r) for r in got] == [(None, 12.5, 15.0, 17.5, 0, None)]


def test_award_trend_across_a_gap(spark):
    rows = [(date(2020, 7, 1), 100), (date(2021, 6, 30), 50), (date(2023, 1, 1), 30)]
    got = {r.fiscal_year: (r.award_amount, r.change) for r in metrics.award_trend(frame(spark, rows, "start_date date, award_amount long")).collect()}
    assert got == {2021: (150, None), 2023: (30, None)}


def test_masked_faculty_show_a_band_only(spark):
    faculty = frame(
        spark,
        [("FAC_1", "Adjunct", "D", 61_000, "x", "555")],
        "faculty_id string, rank string, department string, salary long, tenure_status string, phone string",
    )
    got = views.faculty_masked(faculty, "s")
    assert "phone" not in got.columns and got.collect()[0].salary_band == 50_000
