"""Dashboard figures and report queries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaris import settings
from scholaris.functions.numeric import is_outlier, ratio, z_score
from scholaris.operators.joins import join_groups
from scholaris.operators.views import approved_ethnicity
from scholaris.sources.workspace import stored

C = F.col


def _count(name: str) -> Column:
    return F.count("*").alias(name)


def enrollment_summary(rows: DataFrame) -> DataFrame:
    """Enrollments and mean grade points by major and year, from the governed rows."""
    return rows.groupBy("major", "academic_year").agg(
        _count("total_enrollments"), F.round(F.avg("grade_point"), 6).alias("avg_gpa")
    )


def known_years(enrollments: DataFrame, students: DataFrame) -> DataFrame:
    """Enrollments and grade points of known students, summed by student and year, with the major.

    Summing comes before the join: a student with a third of all rows is one row a year there.
    """
    yearly = (
        enrollments.filter(C("student_id").isNotNull())
        .groupBy("student_id", C("year").alias("academic_year"))
        .agg(_count("enrollments"), F.count("grade_point").alias("graded"), F.sum("grade_point").alias("points"))
    )
    return yearly.join(students.select("student_id", "major"), "student_id")


def summary_of_years(years: DataFrame) -> DataFrame:
    """`enrollment_summary` from the rows of `known_years`."""
    return years.groupBy("major", "academic_year").agg(
        F.sum("enrollments").alias("total_enrollments"), F.round(ratio(F.sum("points"), F.sum("graded")), 6).alias("avg_gpa")
    )


def enrollment_by_major_year(years: DataFrame) -> DataFrame:
    counts = years.groupBy("major", "academic_year").agg(F.sum("enrollments").alias("total_students"))
    return counts.orderBy(C("total_students").desc(), "major", "academic_year")


def total_students(rows: DataFrame, student: str, approximate: bool = False) -> DataFrame:
    counted = F.approx_count_distinct(student) if approximate else F.count_distinct(student)
    return rows.agg(counted.alias("total_students"))


def avg_gpa_by_major(students: DataFrame) -> DataFrame:
    """Mean GPA per major, and overall on the row without a major."""
    figures = [_count("students"), F.round(F.avg("gpa"), 6).alias("avg_gpa")]
    overall = students.agg(*figures).select(F.lit("overall").alias("scope"), F.lit(None).cast("string").alias("major"), "*")
    by_major = students.groupBy("major").agg(*figures).select(F.lit("major").alias("scope"), "*")
    return by_major.unionByName(overall)


def enrollment_by_year(years: DataFrame) -> DataFrame:
    return years.groupBy("academic_year").agg(F.sum("enrollments").alias("enrollments"))


def students_by_major_share(students: DataFrame) -> DataFrame:
    """Students per major and their share; the table is read once, the counts are added up."""
    counts = stored(students.groupBy("major").agg(_count("students")), "majors")
    return counts.withColumn("share", F.round(ratio("students", counts.agg(F.sum("students")).scalar()), 6))


def demographics(students: DataFrame) -> DataFrame:
    return students.groupBy(approved_ethnicity("ethnicity").alias("ethnicity"), "first_generation").agg(
        _count("students")
    )


def at_risk_students(students: DataFrame, below: float = settings.AT_RISK_BELOW) -> DataFrame:
    """Students whose GPA is below the line; an unknown GPA is not at risk."""
    return students.filter(C("gpa") < below).select("student_id", "major", "cohort_year", "gpa")


def invalid_gpa_rows(students: DataFrame) -> DataFrame:
    return students.filter((C("gpa") < 0.0) | (C("gpa") > 4.0)).select("student_id", "major", "gpa")


def staged_grants_with_department(grants: DataFrame, faculty: DataFrame) -> DataFrame:
    """Each grant with its investigator's department."""
    people = faculty.select(C("faculty_id").alias("pi_id"), "department")
    return grants.drop("department").join(people, "pi_id")


def grant_sums_with_department(grants: DataFrame, faculty: DataFrame) -> DataFrame:
    """Grants, awards and publications by investigator and agency, with the department.

    For reports that only add up: summing before the join leaves one row an investigator
    and agency, however many grants they hold.
    """
    sums = (
        grants.filter(C("pi_id").isNotNull())
        .groupBy("pi_id", "funding_agency")
        .agg(
            _count("grants"),
            F.sum("award_amount").alias("award_amount"),
            F.sum("publication_count").alias("publication_count"),
        )
    )
    return sums.join(faculty.select(C("faculty_id").alias("pi_id"), "department"), "pi_id")


def cost_per_publication(grants: DataFrame) -> DataFrame:
    """Award per publication by department, cheapest first; null without publications."""
    sums = grants.groupBy("department").agg(
        ratio(F.sum("award_amount"), F.sum("publication_count")).alias("cost_per_pub")
    )
    return sums.orderBy(C("cost_per_pub").asc_nulls_first(), "department")


def research_totals(grants: DataFrame) -> DataFrame:
    return grants.agg(
        F.sum("award_amount").alias("total_awards"), F.sum("publication_count").alias("total_publications")
    )


def award_by_department(grants: DataFrame) -> DataFrame:
    """Award per department and its share of the total, which the departments' sums add up to."""
    sums = stored(grants.groupBy("department").agg(F.sum("award_amount").alias("award_amount")), "awards")
    return sums.withColumn("share", F.round(ratio("award_amount", sums.agg(F.sum("award_amount")).scalar()), 6))


def award_publication_corr(grants: DataFrame) -> DataFrame:
    return grants.agg(
        _count("grants"),
        F.round(F.corr("award_amount", "publication_count"), 6).alias("correlation"),
        F.round(F.regr_slope("publication_count", "award_amount"), 12).alias("publications_per_dollar"),
    )


def award_publication_points(grants: DataFrame) -> DataFrame:
    return grants.select("grant_id", "award_amount", "publication_count")


def publications_per_dollar_by_agency(grants: DataFrame) -> DataFrame:
    return grants.groupBy("funding_agency").agg(
        F.sum("publication_count").alias("publications"),
        F.sum("award_amount").alias("award_amount"),
        ratio(F.sum("publication_count"), F.sum("award_amount")).alias("publications_per_dollar"),
    )


def agency_department(grants: DataFrame) -> DataFrame:
    """Award by agency and department, long form."""
    return grants.groupBy("department", "funding_agency").agg(F.sum("award_amount").alias("award_amount"))


def agency_department_pivot(grants: DataFrame, agencies: list[str] = settings.FUNDING_AGENCIES) -> DataFrame:
    """The same with a column per listed agency; all others add up in `other`."""
    listed = F.coalesce(C("funding_agency").isin(agencies), F.lit(False))
    cells = agency_department(grants).withColumn("agency", F.when(listed, C("funding_agency")).otherwise("other"))
    return cells.groupBy("department").pivot("agency", [*agencies, "other"]).sum("award_amount")


def top_departments(grants: DataFrame, k: int = 5) -> DataFrame:
    """The k departments with most publications."""
    sums = grants.groupBy("department").agg(
        F.sum("publication_count").alias("publications"), F.sum("award_amount").alias("award_amount")
    )
    return sums.orderBy(C("publications").desc(), "department").limit(k)


def award_outliers(grants: DataFrame, limit: float = settings.Z_LIMIT) -> DataFrame:
    """Grants whose award lies far from the mean of their agency.

    The statistics are written down first: Spark then sees how small they are before it
    plans the join, and does not shuffle the grants for it.
    """
    spread = grants.groupBy("funding_agency").agg(
        F.avg("award_amount").alias("mean"), F.stddev_samp("award_amount").alias("deviation")
    )
    awards = grants.select("grant_id", "funding_agency", "award_amount")
    return (
        join_groups(awards, stored(spread, "spread"), ["funding_agency"])
        .filter(is_outlier("award_amount", C("mean"), C("deviation"), limit))
        .select(
            "grant_id",
            "funding_agency",
            "award_amount",
            F.round(z_score("award_amount", C("mean"), C("deviation")), 6).alias("z_score"),
        )
    )


def profile(df: DataFrame, table: str) -> DataFrame:
    """Row count and the headline figures of a staging table."""

    def mean(c):
        return F.round(F.avg(c), 6)

    figures = {
        "students": lambda: [
            mean("gpa").alias("mean_gpa"),
            F.count_if(C("enrollment_status") == "Graduated").alias("graduated"),
        ],
        "faculty": lambda: [
            mean("salary").alias("mean_salary"),
            F.count_if(C("tenure_status") == "Tenured").alias("tenured"),
        ],
        "grants": lambda: [
            mean("award_amount").alias("mean_award"),
            F.sum("award_amount").alias("total_funding"),
        ],
        "courses": lambda: [
            mean("enrollment").alias("mean_enrollment"),
            mean("avg_rating").alias("mean_rating"),
        ],
        "enrollments": lambda: [],
    }[table]()
    return df.agg(_count("row_count"), *figures)
