"""Governed outputs: pseudonymised rows, masked tables and department sums."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.functions.identity import pseudonym, without_pii
from scholaris.functions.numeric import ratio
from scholaris.settings import APPROVED_ETHNICITIES, SALARY_BAND


_DETAIL = ["major", "grade", "grade_point", "academic_year"]


def fact_rows(fact_enrollment: DataFrame, dim_student: DataFrame) -> DataFrame:
    """The built fact with the student's id and major."""
    return fact_enrollment.join(dim_student.select("student_key", "student_id", "major"), "student_key")


def enrollment_detail(rows: DataFrame) -> DataFrame:
    """Graded rows with the student's own id: internal use only.

    `rows` are the fact with its student (`fact_rows`), or staging joined with the students.
    """
    return rows.select("student_id", *_DETAIL)


def student_enrollment_safe(rows: DataFrame, salt: str) -> DataFrame:
    """The same rows under a pseudonym."""
    return rows.select(pseudonym("student_id", salt).alias("student_pseudonym"), *_DETAIL)


def student_masked(students: DataFrame, salt: str) -> DataFrame:
    return (
        without_pii(students)
        .withColumn("student_id", pseudonym("student_id", salt))
        .withColumnRenamed("student_id", "student_pseudonym")
        .withColumn("ethnicity", approved_ethnicity("ethnicity"))
        .drop("date_enrolled", "date_graduated")
    )


def faculty_masked(faculty: DataFrame, salt: str) -> DataFrame:
    """Pseudonym and the lower end of the salary band instead of id and salary."""
    return without_pii(faculty).select(
        pseudonym("faculty_id", salt).alias("faculty_pseudonym"),
        "rank",
        "department",
        (F.floor(F.col("salary") / SALARY_BAND) * SALARY_BAND).alias("salary_band"),
        "tenure_status",
    )


def faculty_research_safe(sums: DataFrame) -> DataFrame:
    """Research sums per department; no row stands for one person or grant.

    `sums` are grants, awards and publications with a department, one grant a row or summed.
    """
    return (
        sums.groupBy("department")
        .agg(
            F.sum("grants").alias("grants"),
            F.sum("award_amount").alias("award_amount"),
            F.sum("publication_count").alias("publications"),
        )
        .withColumn("cost_per_publication", ratio("award_amount", "publications"))
    )


def fact_grant_sums(fact_research_grant: DataFrame, dim_faculty: DataFrame) -> DataFrame:
    """The built grant fact summed by investigator, with the department."""
    sums = fact_research_grant.groupBy("pi_key").agg(
        F.count("*").alias("grants"),
        F.sum("award_amount").alias("award_amount"),
        F.sum("publication_count").alias("publication_count"),
    )
    return sums.join(dim_faculty.select(F.col("faculty_key").alias("pi_key"), "department"), "pi_key")


def approved_ethnicity(name: str):
    """Groups outside the approved list, and nulls, are reported as Unknown."""
    return F.when(F.col(name).isin(APPROVED_ETHNICITIES), F.col(name)).otherwise("Unknown")
