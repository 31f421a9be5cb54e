"""Business metrics on students, research, teaching and staff.

Student metrics start from the student table: enrollments of unknown or null students
do not count. Per-student work runs on distinct (student, term) or (student, year)
rows, so a student has at most as many rows as there were terms.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholaris import settings
from scholaris.functions import calendar, grades
from scholaris.functions.numeric import clip, ratio
from scholaris.operators import ranking
from scholaris.operators.joins import join_groups
from scholaris.operators.reports import known_years
from scholaris.sources.workspace import stored

C = F.col


def term_retention(enrollments: DataFrame, students: DataFrame) -> DataFrame:
    """Students per major and term, and how many of them enrolled in the next term.

    Terms are Spring and Fall; a Fall student is retained by the following Spring.
    Nobody can have returned after the latest term in the data: see `final_term`.
    """
    terms = (
        enrollments.filter(C("student_id").isNotNull())
        .select("student_id", calendar.term_index("year", "semester").alias("term"))
        .filter(C("term").isNotNull())
        .distinct()
    )
    # Written down: the latest term is looked up in it as well.
    terms = stored(terms, "terms")
    own_terms = Window.partitionBy("student_id").orderBy("term")
    followed = terms.withColumn("retained", F.lead("term").over(own_terms) == C("term") + 1)
    last = terms.agg(F.max("term")).scalar()
    figures = (
        followed.join(students.select("student_id", "major"), "student_id")
        .groupBy("major", "term")
        .agg(F.count("*").alias("students"), F.count_if("retained").alias("retained"))
    )
    return figures.select(
        "major",
        "term",
        "students",
        "retained",
        F.round(ratio("retained", "students"), 6).alias("retention_rate"),
        (C("term") == last).alias("final_term"),
    )


def retention_forecast(retention: DataFrame) -> DataFrame:
    """Linear trend of each major's term retention, one term beyond the data, within 0..1.

    The latest term has no outcome yet, so it is the term that is forecast.
    """
    rate = ratio("retained", "students")
    known = retention.filter(~C("final_term")).withColumn("rate", rate)
    fit = known.groupBy("major").agg(
        F.count("*").alias("terms"),
        (F.max("term") + 1).alias("next_term"),
        F.regr_slope("rate", "term").alias("slope"),
        F.regr_intercept("rate", "term").alias("intercept"),
    )
    expected = C("slope") * C("next_term") + C("intercept")
    return fit.select(
        "major",
        "terms",
        "next_term",
        F.round("slope", 6).alias("slope"),
        F.round(clip(expected, 0.0, 1.0), 6).alias("forecast"),
    )


def cohort_retention(enrollments: DataFrame, students: DataFrame) -> DataFrame:
    """Share of each cohort enrolled k years after entry, k from 0."""
    years = enrollments.filter(C("student_id").isNotNull()).select("student_id", "year").distinct()
    members = students.select("student_id", "cohort_year").distinct()
    since = (C("year") - C("cohort_year")).alias("years_since_entry")
    active = (
        years.join(members, "student_id")
        .filter(C("year") >= C("cohort_year"))
        .groupBy("cohort_year", since)
        .agg(F.count("*").alias("enrolled"))
    )
    sizes = members.groupBy("cohort_year").agg(F.count("*").alias("cohort_size"))
    return active.join(sizes, "cohort_year").select(
        "cohort_year",
        "years_since_entry",
        "enrolled",
        "cohort_size",
        F.round(ratio("enrolled", "cohort_size"), 6).alias("retention_rate"),
    )


def gpa_trend(enrollments: DataFrame, students: DataFrame) -> DataFrame:
    """Mean grade point by major and year, and its change from the major's year before."""
    years = known_years(enrollments, students)
    yearly = years.groupBy("major", "academic_year").agg(ratio(F.sum("points"), F.sum("graded")).alias("gpa"))
    previous = F.lag("gpa").over(Window.partitionBy("major").orderBy("academic_year"))
    return yearly.withColumn("previous", previous).select(
        "major",
        "academic_year",
        F.round("gpa", 6).alias("avg_gpa"),
        F.round(C("gpa") - C("previous"), 6).alias("change"),
    )


def gpa_improvement(enrollments: DataFrame, students: DataFrame) -> DataFrame:
    """Last minus first yearly GPA per student, over years with graded credits."""
    yearly = (
        enrollments.filter(C("student_id").isNotNull())
        .groupBy("student_id", "year")
        .agg(
            grades.credit_weighted_mean("grade_point", "credits_earned").alias("gpa"),
            F.sum(F.when(C("grade_point").isNotNull(), C("credits_earned"))).alias("graded_credits"),
        )
        .filter(C("graded_credits") > 0)
    )
    spans = yearly.groupBy("student_id").agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.min_by("gpa", "year").alias("first"),
        F.max_by("gpa", "year").alias("last"),
    )
    return spans.join(students.select("student_id"), "student_id", "left_semi").select(
        "student_id",
        "first_year",
        "last_year",
        F.round("first", 6).alias("first_gpa"),
        F.round("last", 6).alias("last_gpa"),
        F.round(C("last") - C("first"), 6).alias("improvement"),
    )


def weighted_gpa(enrollments: DataFrame, students: DataFrame) -> DataFrame:
    """Cumulative credit-weighted GPA per student; 0 without enrollments or credits."""
    totals = (
        enrollments.filter(C("student_id").isNotNull())
        .groupBy("student_id")
        .agg(
            grades.weighted_gpa("grade_point", "credits_earned").alias("gpa"),
            F.sum("credits_earned").alias("credits"),
        )
    )
    return students.select("student_id").join(totals, "student_id", "left").select(
        "student_id",
        F.round(F.coalesce("gpa", F.lit(0.0)), 6).alias("weighted_gpa"),
        F.coalesce("credits", F.lit(0).cast("long")).alias("credits"),
    )


def graduation_rate(students: DataFrame) -> DataFrame:
    graduated = F.count_if(C("enrollment_status") == "Graduated")
    return students.groupBy("major", "cohort_year").agg(
        F.count("*").alias("students"),
        graduated.alias("graduated"),
        F.round(ratio(graduated, F.count("*")), 6).alias("graduation_rate"),
    )


def on_time_graduation(students: DataFrame, months: int = 48) -> DataFrame:
    """Share of each major's graduates who finished within `months` of enrolling."""
    on_time = F.count_if(C("date_graduated") <= F.add_months("date_enrolled", months))
    return (
        students.filter(C("enrollment_status") == "Graduated")
        .groupBy("major")
        .agg(
            F.count("*").alias("graduates"),
            on_time.alias("on_time"),
            F.round(ratio(on_time, F.count("*")), 6).alias("on_time_rate"),
        )
    )


def enrollment_status(
    enrollments: DataFrame, students: DataFrame, as_of: date = settings.AS_OF, years: int = 1
) -> DataFrame:
    """Graduated by date; Active with an enrollment in the last `years` academic years; else Inactive."""
    last = (
        enrollments.filter(C("student_id").isNotNull()).groupBy("student_id").agg(F.max("year").alias("last_year"))
    )
    this_year = as_of.year + (1 if as_of.month >= 8 else 0)
    status = (
        F.when(C("date_graduated") <= F.lit(as_of), "Graduated")
        .when(C("last_year") >= this_year - years, "Active")
        .otherwise("Inactive")
    )
    return students.select("student_id", "enrollment_status", "date_graduated").join(last, "student_id", "left").select(
        "student_id", C("enrollment_status").alias("recorded_status"), "last_year", status.alias("derived_status")
    )


def _research_by_pi(grants: DataFrame) -> DataFrame:
    return grants.groupBy(C("pi_id").alias("faculty_id")).agg(
        F.sum("publication_count").alias("publications"), F.sum("award_amount").alias("award_amount")
    )


def productivity_score() -> Column:
    """Publications per $100,000 awarded."""
    return ratio(C("publications") * 100_000, C("award_amount"))


def faculty_scores(faculty: DataFrame, grants: DataFrame) -> DataFrame:
    """Faculty with their productivity score; null without grants."""
    return faculty.join(_research_by_pi(grants), "faculty_id", "left").withColumn("score", productivity_score())


def faculty_productivity(faculty: DataFrame, grants: DataFrame, courses: DataFrame) -> DataFrame:
    """Score, percentile among faculty of the same rank, and mean course rating."""
    everyone = stored(faculty_scores(faculty.select("faculty_id", "rank", "department"), grants), "scores")
    # Only faculty with a score have a standing: nobody meets anybody on a null.
    scored = everyone.filter(C("score").isNotNull())
    standing = ranking.percent_rank(scored, "rank", "score", "rank_percentile")
    ranked = join_groups(scored, standing, ["rank", "score"], "left")
    others = everyone.filter(C("score").isNull()).withColumn("rank_percentile", F.lit(None).cast("double"))
    ratings = courses.groupBy(C("instructor_id").alias("faculty_id")).agg(
        F.round(F.avg("avg_rating"), 6).alias("mean_rating")
    )
    return (
        ranked.select(*others.columns)
        .unionByName(others)
        .join(ratings, "faculty_id", "left")
        .select(
            "faculty_id",
            "rank",
            "department",
            F.round("score", 6).alias("score"),
            F.round("rank_percentile", 6).alias("rank_percentile"),
            "mean_rating",
        )
    )


def research_roi(grants: DataFrame) -> DataFrame:
    """Awards, publications and the ratios between them, by department, from grants that were summed."""
    award, publications = F.sum("award_amount"), F.sum("publication_count")
    return grants.groupBy("department").agg(
        F.sum("grants").alias("grants"),
        award.alias("award_amount"),
        publications.alias("publications"),
        F.round(ratio(publications * 100_000, award), 6).alias("publications_per_100k"),
        F.round(ratio(award, publications), 6).alias("cost_per_publication"),
    )


def salary_vs_productivity(faculty: DataFrame, grants: DataFrame) -> DataFrame:
    """Salary quartiles by department, and how salary goes with the productivity score."""
    quartiles = ranking.percentiles(faculty, "department", "salary", [25, 50, 75])
    scored = faculty_scores(faculty.select("faculty_id", "department", "salary"), grants)
    both = C("score").isNotNull() & C("salary").isNotNull()
    spread = (F.min(F.when(both, C("score"))) < F.max(F.when(both, C("score")))) & (
        F.min(F.when(both, C("salary"))) < F.max(F.when(both, C("salary")))
    )
    relation = scored.groupBy("department").agg(
        F.count_if(both).alias("scored"),
        F.round(F.when(spread, F.corr("salary", "score")), 6).alias("correlation"),
    )
    return join_groups(relation, quartiles, ["department"], "left").select(
        "department",
        *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")],
        "scored",
        "correlation",
    )


def course_performance(courses: DataFrame, faculty: DataFrame) -> DataFrame:
    """Enrollment-weighted pass rate and mean rating by the instructor's department."""
    people = faculty.select(C("faculty_id").alias("instructor_id"), "department")
    graded = F.when(C("pass_rate").isNotNull(), C("enrollment"))
    return (
        courses.join(people, "instructor_id")
        .groupBy("department")
        .agg(
            F.count("*").alias("courses"),
            F.sum("enrollment").alias("enrollment"),
            F.round(ratio(F.sum(C("pass_rate") * C("enrollment")), F.sum(graded)), 6).alias("pass_rate"),
            F.round(F.avg("avg_rating"), 6).alias("mean_rating"),
        )
    )


def award_trend(grants: DataFrame) -> DataFrame:
    """Awards by fiscal year of the start date, and the change from the year before."""
    yearly = grants.groupBy(calendar.fiscal_year("start_date").alias("fiscal_year")).agg(
        F.count("*").alias("grants"), F.sum("award_amount").alias("award_amount")
    )
    before = yearly.select((C("fiscal_year") + 1).alias("fiscal_year"), C("award_amount").alias("previous"))
    return yearly.join(before, "fiscal_year", "left").select(
        "fiscal_year",
        "grants",
        "award_amount",
        (C("award_amount") - C("previous")).alias("change"),
        F.round(ratio(C("award_amount") - C("previous"), "previous"), 6).alias("change_share"),
    )
