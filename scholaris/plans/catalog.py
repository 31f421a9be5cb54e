"""The register of named queries: each takes a session and a directory of tables.

A query stands next to the SQL that gives the same rows on another engine, where SQL
can say it.
"""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from scholaris.operators import quality, reports, star, views
from scholaris.operators.ranking import positioned
from scholaris.plans.oracle import with_tables
from scholaris.sources.derived import StagingTables, enrollments
from scholaris.sources.workspace import stored

# The salt of the registered queries. Real runs pass their own, from a secret store.
EXAMPLE_SALT = "example-salt"


class Tables(StagingTables):
    """Staging and star tables of one query; a dimension is built once and shared."""

    @cached_property
    def dim_student(self) -> DataFrame:
        return star.dim_student(self.positioned("students"))

    @cached_property
    def dim_faculty(self) -> DataFrame:
        return star.dim_faculty(self.positioned("faculty"))

    @cached_property
    def fact_enrollment(self) -> DataFrame:
        return star.fact_enrollment(self.positioned("enrollments"), self.dim_student)

    @cached_property
    def known_enrollments(self) -> DataFrame:
        """The fact's rows with the student's major, for reports that need no surrogate key."""
        rows = self.enrollments.join(self.students.select("student_id", "major"), "student_id")
        return rows.withColumnRenamed("year", "academic_year")

    @cached_property
    def fact_research_grant(self) -> DataFrame:
        return star.fact_research_grant(self.positioned("grants"), self.dim_faculty)

    @cached_property
    def known_years(self) -> DataFrame:
        return reports.known_years(self.enrollments, self.students)

    @cached_property
    def grant_sums(self) -> DataFrame:
        return reports.grant_sums_with_department(self.grants, self.faculty)

    @cached_property
    def staged_grants_by_department(self) -> DataFrame:
        return reports.staged_grants_with_department(self.grants, self.faculty)

    @cached_property
    def checks(self) -> DataFrame:
        return quality.report(self.all())

    def landed(self) -> "LandedTables":
        return LandedTables(self.spark, self.directory)

    def safe_rows(self) -> DataFrame:
        return views.student_enrollment_safe(self.known_enrollments, EXAMPLE_SALT)


class LandedTables(Tables):
    """The same for queries that pass over the enrollments several times.

    Enrollments come out of a join of two large tables: they are written down once, and
    each pass then reads only the columns it needs.
    """

    @cached_property
    def enrollments(self) -> DataFrame:
        return stored(enrollments(self.source("lineitem"), self.source("orders")), "enrollments")

    def positioned(self, name: str) -> DataFrame:
        if name == "enrollments":
            return positioned(self.enrollments, in_files=True)
        return super().positioned(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `build(tables) -> DataFrame` under a name."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, directory: build(Tables(spark, directory))
        if sql is not None:
            ORACLE[name] = with_tables(sql)
        return build

    return register


def load() -> None:
    """Import the modules that register queries."""
    from scholaris.plans import (  # noqa: F401
        function_queries,
        metric_queries,
        quality_queries,
        report_queries,
        staging_queries,
        star_queries,
    )
