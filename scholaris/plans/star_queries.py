"""Star schema and governed views."""

from scholaris.operators import integrity, reports, star, views
from scholaris.plans.catalog import EXAMPLE_SALT, Tables, query

_PSEUDONYM = f"sha256({{}} || '{EXAMPLE_SALT}')[1:16]"


@query(
    "students_cleaned",
    """select student_id, cohort_year, upper(major) as major, round(gpa, 2) as gpa, enrollment_status, date_enrolled
       from students""",
)
def students_cleaned(t: Tables):
    return star.students_cleaned(t.students)


@query("dim_student", "select * from dim_student")
def dim_student(t: Tables):
    return t.dim_student


@query("dim_faculty", "select * from dim_faculty")
def dim_faculty(t: Tables):
    return t.dim_faculty


@query(
    "dim_course",
    """select row_number() over (order by course_id nulls first, course_code nulls first, course_title nulls first,
                                          credits nulls first, instructor_id nulls first) as course_key,
              course_id, course_code, course_title, credits, instructor_id from courses""",
)
def dim_course(t: Tables):
    return star.dim_course(t.positioned("courses"))


@query(
    "dim_department",
    """select row_number() over (order by department nulls first) as department_key, department
       from (select distinct department from faculty) d""",
)
def dim_department(t: Tables):
    return star.dim_department(t.faculty)


@query(
    "dim_funding_agency",
    """select row_number() over (order by funding_agency nulls first) as agency_key, funding_agency
       from (select distinct funding_agency from grants) a""",
)
def dim_funding_agency(t: Tables):
    return star.dim_funding_agency(t.grants)


@query(
    "dim_date",
    """select distinct cast(strftime(date_enrolled, '%Y%m%d') as bigint) as date_key, date_enrolled as calendar_date,
              cohort_year as academic_year from students""",
)
def dim_date(t: Tables):
    return star.dim_date(t.students)


@query(
    "dim_date_august_rule",
    """select distinct cast(strftime(date_enrolled, '%Y%m%d') as bigint) as date_key, date_enrolled as calendar_date,
              cast(year(date_enrolled) + case when month(date_enrolled) >= 8 then 1 else 0 end as bigint) as academic_year
       from students""",
)
def dim_date_august_rule(t: Tables):
    return star.dim_date(t.students, august_rule=True)


@query("fact_enrollment", "select * from fact_enrollment")
def fact_enrollment(t: Tables):
    return t.fact_enrollment


@query("fact_research_grant", "select * from fact_research_grant")
def fact_research_grant(t: Tables):
    return t.fact_research_grant


@query(
    "fact_student_performance",
    """select student_id, year as academic_year, count(course_id) as courses,
              cast(sum(credits_earned) as bigint) as credits_earned,
              round(coalesce(sum(grade_point * credits_earned)
                    / nullif(sum(case when grade_point is not null then credits_earned end), 0), 0), 6) as gpa
       from enrollments where student_id in (select student_id from students) group by student_id, year""",
)
def fact_student_performance(t: Tables):
    return star.fact_student_performance(t.enrollments, t.students)


@query(
    "fact_faculty_productivity",
    """select f.faculty_id, f.rank, f.department, coalesce(g.n, 0) as grants, coalesce(g.award, 0) as award_amount,
              coalesce(g.pubs, 0) as publications, coalesce(c.n, 0) as courses, c.rating as mean_rating
       from faculty f
       left join (select pi_id, count(*) as n, cast(sum(award_amount) as bigint) as award,
                         cast(sum(publication_count) as bigint) as pubs from grants group by pi_id) g
         on g.pi_id = f.faculty_id
       left join (select instructor_id, count(*) as n, round(avg(avg_rating), 6) as rating
                  from courses group by instructor_id) c on c.instructor_id = f.faculty_id""",
)
def fact_faculty_productivity(t: Tables):
    return star.fact_faculty_productivity(t.faculty, t.grants, t.courses)


@query(
    "fact_course_performance",
    """select c.course_id, coalesce(e.graded, 0) as graded, round(e.failed / nullif(e.graded, 0), 6) as fail_share,
              e.points as mean_grade_point, c.pass_rate as listed_pass_rate
       from courses c
       left join (select course_id, count(grade) as graded, count(*) filter (where grade = 'F') as failed,
                         round(avg(grade_point), 6) as points from enrollments group by course_id) e
         on e.course_id = c.course_id""",
)
def fact_course_performance(t: Tables):
    return star.fact_course_performance(t.courses, t.enrollments)


@query("enrollment_detail", "select * from enrollment_detail")
def enrollment_detail(t: Tables):
    return views.enrollment_detail(t.known_enrollments)


@query(
    "student_enrollment_safe",
    f"""select {_PSEUDONYM.format("student_id")} as student_pseudonym, major, grade, grade_point, academic_year
        from enrollment_detail""",
)
def student_enrollment_safe(t: Tables):
    return t.safe_rows()


@query(
    "enrollment_summary",
    """select major, academic_year, count(*) as total_enrollments, round(avg(grade_point), 6) as avg_gpa
       from enrollment_detail group by major, academic_year""",
)
def enrollment_summary(t: Tables):
    return reports.summary_of_years(t.known_years)


@query(
    "faculty_research_safe",
    """select department, count(*) as grants, cast(sum(award_amount) as bigint) as award_amount,
              cast(sum(publication_count) as bigint) as publications,
              sum(award_amount) / nullif(sum(publication_count), 0) as cost_per_publication
       from grants_by_department group by department""",
)
def faculty_research_safe(t: Tables):
    return views.faculty_research_safe(t.grant_sums)


@query(
    "student_masked",
    f"""select {_PSEUDONYM.format("student_id")} as student_pseudonym, cohort_year, major, gpa, enrollment_status,
               credits_completed, ethnicity, first_generation
        from (select * replace (case when ethnicity in ('Asian', 'Black', 'Hispanic', 'Native American',
                     'Non-Resident Alien', 'Two or More Races', 'White', 'Unknown') then ethnicity
                     else 'Unknown' end as ethnicity) from students) s""",
)
def student_masked(t: Tables):
    return views.student_masked(t.students, EXAMPLE_SALT)


@query(
    "faculty_masked",
    f"""select {_PSEUDONYM.format("faculty_id")} as faculty_pseudonym, rank, department,
               cast(floor(salary / 25000) * 25000 as bigint) as salary_band, tenure_status from faculty""",
)
def faculty_masked(t: Tables):
    return views.faculty_masked(t.faculty, EXAMPLE_SALT)


@query(
    "duplicate_rows_marked",
    """select *, row_number() over (partition by enrollment_id order by position) > 1 as is_duplicate
       from (select row_number() over (order by enrollment_id nulls first, student_id nulls first, course_id nulls first,
                                                year nulls first, semester nulls first, grade_point nulls first,
                                                grade nulls first, credits_earned nulls first) as position, *
             from enrollments) e""",
)
def duplicate_rows_marked(t: Tables):
    order = ["student_id", "course_id", "year", "semester", "grade_point", "grade", "credits_earned"]
    return integrity.duplicate_rows(t.positioned("enrollments"), "enrollment_id", order)
