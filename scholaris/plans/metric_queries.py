"""Business metrics."""

from datetime import date

from pyspark.sql import functions as F

from scholaris.operators import distinct, metrics, ranking, sketches
from scholaris.plans.catalog import Tables, query
from scholaris.sources.workspace import stored

_WEIGHTED = "sum(grade_point * credits_earned) / nullif(sum(case when grade_point is not null then credits_earned end), 0)"
_YEARLY = f"""(select student_id, year, {_WEIGHTED} as gpa from enrollments
               where student_id in (select student_id from students) group by student_id, year
               having sum(case when grade_point is not null then credits_earned end) > 0) y"""


@query("term_retention", "select * from term_retention")
def term_retention(t: Tables):
    return metrics.term_retention(t.enrollments, t.students)


@query(
    "retention_forecast",
    """select major, terms, next_term, round(slope, 6) as slope,
              round(least(greatest(slope * next_term + intercept, 0), 1), 6) as forecast
       from (select major, count(*) as terms, max(term) + 1 as next_term, regr_slope(retained / students::double, term) as slope,
                    regr_intercept(retained / students::double, term) as intercept
             from term_retention where not final_term group by major) f""",
)
def retention_forecast(t: Tables):
    return metrics.retention_forecast(metrics.term_retention(t.enrollments, t.students))


@query(
    "cohort_retention",
    """select cohort_year, years_since_entry, enrolled, cohort_size,
              round(enrolled / cohort_size::double, 6) as retention_rate
       from (select s.cohort_year, e.year - s.cohort_year as years_since_entry, count(distinct e.student_id) as enrolled
             from enrollments e join students s using (student_id) where e.year >= s.cohort_year group by 1, 2) a
       join (select cohort_year, count(distinct student_id) as cohort_size from students group by 1) c
         using (cohort_year)""",
)
def cohort_retention(t: Tables):
    return metrics.cohort_retention(t.enrollments, t.students)


@query(
    "gpa_trend",
    """select major, academic_year, round(gpa, 6) as avg_gpa,
              round(gpa - lag(gpa) over (partition by major order by academic_year), 6) as change
       from (select s.major, e.year as academic_year, avg(e.grade_point) as gpa
             from enrollments e join students s using (student_id) group by 1, 2) y""",
)
def gpa_trend(t: Tables):
    return metrics.gpa_trend(t.enrollments, t.students)


@query(
    "gpa_improvement",
    f"""select student_id, min(year) as first_year, max(year) as last_year, round(arg_min(gpa, year), 6) as first_gpa,
               round(arg_max(gpa, year), 6) as last_gpa, round(arg_max(gpa, year) - arg_min(gpa, year), 6) as improvement
        from {_YEARLY} group by student_id""",
)
def gpa_improvement(t: Tables):
    return metrics.gpa_improvement(t.enrollments, t.students)


@query(
    "weighted_gpa",
    f"""select s.student_id, round(coalesce(e.gpa, 0), 6) as weighted_gpa, coalesce(e.credits, 0) as credits
        from students s left join (select student_id, {_WEIGHTED} as gpa, cast(sum(credits_earned) as bigint) as credits
                                   from enrollments group by student_id) e using (student_id)""",
)
def weighted_gpa(t: Tables):
    return metrics.weighted_gpa(t.enrollments, t.students)


@query(
    "graduation_rate",
    """select major, cohort_year, count(*) as students,
              count(*) filter (where enrollment_status = 'Graduated') as graduated,
              round(count(*) filter (where enrollment_status = 'Graduated') / count(*)::double, 6) as graduation_rate
       from students group by 1, 2""",
)
def graduation_rate(t: Tables):
    return metrics.graduation_rate(t.students)


@query(
    "on_time_graduation",
    """select major, count(*) as graduates,
              count(*) filter (where date_graduated <= date_enrolled + interval 48 month) as on_time,
              round(count(*) filter (where date_graduated <= date_enrolled + interval 48 month) / count(*)::double, 6)
                as on_time_rate
       from students where enrollment_status = 'Graduated' group by major""",
)
def on_time_graduation(t: Tables):
    return metrics.on_time_graduation(t.students)


@query(
    "enrollment_status_derived",
    """select student_id, enrollment_status as recorded_status, last_year,
              case when date_graduated <= date '2022-07-16' then 'Graduated' when last_year >= 2021 then 'Active'
                   else 'Inactive' end as derived_status
       from students left join (select student_id, max(year) as last_year from enrollments group by student_id) e
         using (student_id)""",
)
def enrollment_status_derived(t: Tables):
    return metrics.enrollment_status(t.enrollments, t.students, as_of=date(2022, 7, 16))


@query(
    "faculty_productivity",
    """select s.faculty_id, s.rank, s.department, round(s.score, 6) as score,
              round(p.rank_percentile, 6) as rank_percentile, c.mean_rating
       from faculty_scores s
       left join (select faculty_id, percent_rank() over (partition by rank order by score) as rank_percentile
                  from faculty_scores where score is not null) p using (faculty_id)
       left join (select instructor_id as faculty_id, round(avg(avg_rating), 6) as mean_rating
                  from courses group by 1) c using (faculty_id)""",
)
def faculty_productivity(t: Tables):
    return metrics.faculty_productivity(t.faculty, t.grants, t.courses)


@query(
    "research_roi",
    """select department, count(*) as grants, cast(sum(award_amount) as bigint) as award_amount,
              cast(sum(publication_count) as bigint) as publications,
              round(sum(publication_count) * 100000e0 / nullif(sum(award_amount), 0), 6) as publications_per_100k,
              round(sum(award_amount) / nullif(sum(publication_count), 0), 6) as cost_per_publication
       from staged_grants_by_department group by department""",
)
def research_roi(t: Tables):
    return metrics.research_roi(t.grant_sums)


@query(
    "salary_vs_productivity",
    """select department, round(quantile_cont(salary, 0.25), 6) as p25, round(quantile_cont(salary, 0.5), 6) as p50,
              round(quantile_cont(salary, 0.75), 6) as p75, count(score) as scored,
              case when min(score) < max(score)
                    and min(salary) filter (where score is not null) < max(salary) filter (where score is not null)
                   then round(corr(salary, score), 6) end as correlation
       from faculty_scores group by department""",
)
def salary_vs_productivity(t: Tables):
    return metrics.salary_vs_productivity(t.faculty, t.grants)


@query(
    "salary_percentiles",
    """select rank, round(quantile_cont(salary, 0.1), 6) as p10, round(quantile_cont(salary, 0.5), 6) as p50,
              round(quantile_cont(salary, 0.9), 6) as p90, round(quantile_cont(salary, 0.95), 6) as p95
       from faculty group by rank""",
)
def salary_percentiles(t: Tables):
    wanted = ranking.percentiles(t.faculty, "rank", "salary", [10, 50, 90, 95])
    return wanted.select("rank", *[F.round(c, 6).alias(c) for c in wanted.columns if c != "rank"])


@query(
    "course_performance",
    """select f.department, count(*) as courses, cast(sum(c.enrollment) as bigint) as enrollment,
              round(sum(c.pass_rate * c.enrollment) / sum(c.enrollment), 6) as pass_rate,
              round(avg(c.avg_rating), 6) as mean_rating
       from courses c join faculty f on c.instructor_id = f.faculty_id group by f.department""",
)
def course_performance(t: Tables):
    return metrics.course_performance(t.courses, t.faculty)


@query(
    "award_trend",
    """select fiscal_year, grants, award_amount, award_amount - previous as change,
              round((award_amount - previous) / nullif(previous, 0)::double, 6) as change_share
       from (select *, lag(award_amount) over (order by fiscal_year) as previous
             from (select cast(year(start_date) + case when month(start_date) >= 7 then 1 else 0 end as bigint)
                            as fiscal_year,
                          count(*) as grants, cast(sum(award_amount) as bigint) as award_amount
                   from grants group by 1) y) z""",
)
def award_trend(t: Tables):
    return metrics.award_trend(t.grants)


_SPANS = ((2016, 2018), (2013, 2030), (2019, 2019), (1900, 1901))
_SPAN_ROWS = ", ".join(f"(cast({a} as bigint), cast({b} as bigint))" for a, b in _SPANS)
_ENROLLED = "select distinct e.year, student_id from enrollments e join students s using (student_id)"


def _member_bits(t: Tables):
    """Students of each year as bitmaps on their dense keys, stored once."""
    yearly = t.enrollments.select("student_id", F.col("year").alias("academic_year")).distinct()
    keys = t.dim_student.select("student_id", "student_key")
    return stored(distinct.bitmaps(yearly.join(keys, "student_id"), "academic_year", "student_key"), "members")


def _pairs(t: Tables, pairs):
    return t.spark.createDataFrame(list(pairs), "first long, last long")


@query(
    "distinct_students_by_span",
    f"""select first, last, count(distinct student_id) as members
        from (values {_SPAN_ROWS}) spans(first, last) left join ({_ENROLLED}) e on e.year between first and last group by first, last""",
)
def distinct_students_by_span(t: Tables):
    return distinct.distinct_in_spans(_member_bits(t), _pairs(t, _SPANS), "academic_year")


_RETURNS = tuple((year, year + 1) for year in range(2013, 2020)) + ((2018, 2018),)
_RETURN_ROWS = ", ".join(f"(cast({a} as bigint), cast({b} as bigint))" for a, b in _RETURNS)


@query(
    "returning_students_by_year",
    f"""select first, last, count(distinct b.student_id) as members
        from (values {_RETURN_ROWS}) pairs(first, last)
        left join ({_ENROLLED}) a on a.year = first left join ({_ENROLLED}) b on b.year = last and b.student_id = a.student_id
        group by first, last""",
)
def returning_students_by_year(t: Tables):
    return distinct.common_in_periods(_member_bits(t), _pairs(t, _RETURNS), "academic_year")


_PERCENTS = (5.0, 25.0, 50.0, 75.0, 95.0)


@query(
    "percentiles_from_sketches",
    f"""select major, percent, n, true as within
        from (select s.major, count(e.grade_point) as n from enrollments e join students s using (student_id) group by s.major) g,
             (values {", ".join(f"(cast({p} as double))" for p in _PERCENTS)}) p(percent)""",
)
def percentiles_from_sketches(t: Tables):
    """Percentiles of grade points by major, merged from a sketch for each major and year, and whether
    the rank of each is as near as promised, held against all rows."""
    rows = stored(t.known_enrollments.select("major", "academic_year", "grade_point"), "known")
    by_load = stored(sketches.sketched(rows, ["major", "academic_year"], "grade_point"), "sketches")
    found = sketches.percentiles(sketches.merged(by_load, ["major"]), ["major"], list(_PERCENTS))
    cells = [F.struct(F.lit(p).alias("percent"), F.col(f"p{p:g}").alias("value")) for p in _PERCENTS]
    long = found.select("major", "n", F.inline(F.array(*cells)))
    # Ranks from the counts of values, of which there are few beside the rows.
    counts = rows.where(F.col("grade_point").isNotNull()).groupBy("major", "grade_point").agg(F.count("*").alias("c"))
    ranks = long.join(counts, "major").groupBy("major", "percent", "n").agg(
        F.sum(F.when(F.col("grade_point") < F.col("value"), F.col("c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("grade_point") <= F.col("value"), F.col("c")).otherwise(0)).alias("upto"),
    )
    off = sketches.rank_error() * F.col("n") + 1
    rank = F.col("percent") / 100.0 * F.col("n")
    within = (F.col("below") <= rank + off) & (F.col("upto") >= rank - off)
    return ranks.select("major", "percent", "n", within.alias("within"))
